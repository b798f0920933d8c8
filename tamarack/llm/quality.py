"""Quality by a linear-chain conditional random field over a document's lines.

Each line is good or bad.  Its state's weight comes from features of the line and of the lines before and after it,
and from the step between neighbouring states; a document's lines are learnt with its label.  Forward-backward gives
each line's marginal probability of being good; their mean, weighted by length, is the document's raw quality, which a
logistic curve fitted on the same rows turns into the probability of label 1.

The fit uses at most ``SAMPLE_DOCS`` labelled documents of at most ``SAMPLE_LINES`` lines, none held out; every
document is scored, whole.  A task holds one batch of rows.

Defined cases: null and empty texts are one empty line; with no labelled rows, or labels of one kind only, the score is
the share of label 1 (0.5 without any); repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import texts
from tamarack.llm.labelled import held_out, training_rows

SAMPLE_DOCS = 3_000
SAMPLE_LINES = 2_000
THRESHOLD = 0.3
ROWS = 256  # documents of a scoring batch

_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
_DIGIT = re.compile(r"[0-9]")
FEATURES = 14


def line_features(line: str, seen: bool) -> list[float]:
    """What a line looks like, apart from its language."""
    words = line.split()
    n = len(words)
    size = len(line)
    if not n:
        return [1.0, math.log1p(size)] + [0.0] * (FEATURES - 3) + [float(seen)]
    capitals = sum(map(str.isupper, words))
    short = sum(len(w) <= 3 for w in words)
    return [
        0.0,
        math.log1p(size),
        math.log1p(n),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        capitals / n,
        min(len(_SYMBOL.findall(line)) / n, 4.0),
        words.count("|") / n,
        min(line.count("!") / n, 3.0),
        min(len(_DIGIT.findall(line)) / n, 4.0),
        min(size / n, 40.0) / 10,
        short / n,
        float(line.rstrip()[-1:] in ".!?"),
        float(seen),
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line with those of its neighbours and a constant, lengths of the lines)."""
    lines = text.split("\n")
    seen: set[str] = set()
    rows = []
    for line in lines:
        rows.append(line_features(line, line in seen))
        seen.add(line)
    own = np.array(rows, dtype=np.float64)
    n = len(own)
    out = np.zeros((n, 3 * FEATURES + 3))
    out[:, :FEATURES] = own
    out[1:, FEATURES : 2 * FEATURES] = own[:-1]
    out[:-1, 2 * FEATURES : 3 * FEATURES] = own[1:]
    out[0, -3] = out[-1, -2] = 1.0  # first line, last line
    out[:, -1] = 1.0
    return out, np.array([len(x) + 1 for x in lines], dtype=np.float64)


def _chains(
    scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, steps: np.ndarray, weight: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once, those of equal position together.

    ``scores``: weight of good against bad, per line of all chains.  Returns the marginals of good, per line; the
    expected counts of the four steps, summed (each with the ``weight`` of its line); and each chain's log normaliser.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    total = len(scores)
    forward, backward = np.zeros((total, 2)), np.zeros((total, 2))
    emit = np.stack([np.zeros(total), scores], axis=1)
    most = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(1, most + 1), side="right")  # chains that reach a position
    for t in range(most):
        at = starts[: alive[t]] + t
        if t == 0:
            forward[at] = emit[at]
        else:
            before = forward[at - 1]
            forward[at] = np.logaddexp(before[:, :1] + steps[0], before[:, 1:] + steps[1]) + emit[at]
    for t in range(most - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        after = backward[at + 1] + emit[at + 1]
        backward[at, 0] = np.logaddexp(after[:, 0] + steps[0, 0], after[:, 1] + steps[0, 1])
        backward[at, 1] = np.logaddexp(after[:, 0] + steps[1, 0], after[:, 1] + steps[1, 1])
    ends = starts + lengths - 1
    norm = np.logaddexp(forward[ends, 0], forward[ends, 1])
    of_line = np.zeros(total)
    for_chain = np.repeat(norm, lengths)
    lines = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths, strict=True)]) if total else np.zeros(0, dtype=int)
    of_line[lines] = for_chain
    good = np.exp(np.clip(forward[:, 1] + backward[:, 1] - of_line, -700, 0))
    inner = np.ones(total, dtype=bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    counts = np.zeros((2, 2))
    if len(at):
        tail = backward[at] + emit[at]
        for a in range(2):
            for b in range(2):
                share = np.exp(np.clip(forward[at - 1, a] + steps[a, b] + tail[:, b] - of_line[at], -700, 0))
                counts[a, b] = share.sum() if weight is None else share @ weight[at]
    back = np.empty(len(norm))
    back[order] = norm
    return good, counts, back


class LineModel:
    """A fitted field: weights of the features, of the four steps, and the curve from raw quality to probability."""

    def __init__(self, scale: np.ndarray, shift: np.ndarray, weights: np.ndarray, steps: np.ndarray, curve: tuple[float, float]):
        self.scale, self.shift, self.weights, self.steps, self.curve = scale, shift, weights, steps, curve

    def raw(self, features: np.ndarray, sizes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted mean of each chain's marginals."""
        scores = ((features - self.shift) * self.scale) @ self.weights
        good, _, _ = _chains(scores, starts, lengths, self.steps)
        return np.add.reduceat(good * sizes, starts) / np.add.reduceat(sizes, starts)

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        parts = [document_features(t) for t in texts]
        lengths = np.array([len(s) for _, s in parts])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        raw = self.raw(np.concatenate([f for f, _ in parts]), np.concatenate([s for _, s in parts]), starts, lengths)
        return _sigmoid(self.curve[0] * _logit(raw) + self.curve[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def likelihood(
    params: np.ndarray, x: np.ndarray, y: np.ndarray, starts: np.ndarray, lengths: np.ndarray, weight: np.ndarray, ridge: np.ndarray
) -> tuple[float, np.ndarray]:
    """Sum of the chains' weighted log likelihoods, less ridge/2 of each squared parameter, and its slope.

    ``params``: weights of the features, then of the four steps; ``y``: labels by line; ``weight``: by line, one per chain.
    """
    width = x.shape[1]
    steps, scores = params[width:].reshape(2, 2), x @ params[:width]
    good, counts, norms = _chains(scores, starts, lengths, steps, weight)
    inner = np.ones(len(y), dtype=bool)
    inner[starts] = False
    follows = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[follows - 1].astype(int), y[follows].astype(int)), weight[follows])
    value = weight @ (y * scores) + (seen * steps).sum() - weight[starts] @ norms - (ridge * params**2).sum() / 2
    return float(value), np.concatenate([x.T @ (weight * (y - good)), (seen - counts).ravel()]) - ridge * params


def fit(
    documents: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    *,
    rounds: int = 150,
    rate: float = 0.1,
    ridge: float = 1e-3,
    step_ridge: float = 0.01,
) -> LineModel:
    """Maximum of the chains' likelihood by Adam; both labels weigh the same, and every document 1 over its lines.

    All lines of a document have its label, so ``step_ridge`` alone keeps steps from drowning a line's own features.
    """
    width = 3 * FEATURES + 3
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return LineModel(np.ones(width), np.zeros(width), np.zeros(width), np.zeros((2, 2)), (0.0, math.log(share / (1 - share))))
    features = np.concatenate([f for f, _ in documents])
    sizes = np.concatenate([s for _, s in documents])
    lengths = np.array([len(s) for _, s in documents])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    shift = features.mean(axis=0)
    scale = 1 / np.maximum(features.std(axis=0), 1e-3)
    shift[-1], scale[-1] = 0.0, 1.0
    x = (features - shift) * scale
    y = np.repeat(labels.astype(np.float64), lengths)
    # Per document 1/its lines, and the rarer label as much as the other in sum.
    weight = np.repeat(np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / lengths / len(labels), lengths)
    params = np.zeros(width + 4)
    ridges = np.concatenate([np.full(width, ridge), np.full(4, step_ridge)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, rounds + 1):
        _, slope = likelihood(params, x, y, starts, lengths, weight, ridges)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        params = params + rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    model = LineModel(scale, shift, params[:width], params[width:].reshape(2, 2), (1.0, 0.0))
    z = _logit(model.raw(features, sizes, starts, lengths))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic fit with a light ridge
        p = _sigmoid(a * z + b)
        w = p * (1 - p) + 1e-9
        g = np.array([np.sum((labels - p) * z) - 0.1 * (a - 1), np.sum(labels - p)])
        h = np.array([[np.sum(w * z * z) + 0.1, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    model.curve = (float(a), float(b))
    return model


def train(docs: DataFrame, labels: DataFrame, *, most: int = SAMPLE_DOCS) -> LineModel:
    """Fit on the sample; its line features, not its texts, come to the driver."""
    rows = training_rows(texts(docs), labels, "quality", most)
    # Short of line breaks: a document of more lines isn't learnt from.
    rows = rows.filter(F.regexp_count("text", F.lit("\n")) < SAMPLE_LINES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [document_features(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "features": [f.astype(np.float32).tobytes() for f, _ in parts],
                    "sizes": [s.astype(np.float32).tobytes() for _, s in parts],
                }
            )

    got = rows.mapInPandas(run, "doc_id long, label int, features binary, sizes binary").toPandas()
    got = got.sort_values(["doc_id", "label", "sizes"], ignore_index=True)
    width = 3 * FEATURES + 3
    documents = [
        (np.frombuffer(f, np.float32).astype(np.float64).reshape(-1, width), np.frombuffer(s, np.float32).astype(np.float64))
        for f, s in zip(got["features"], got["sizes"], strict=True)
    ]
    return fit(documents, got["label"].to_numpy())


def score(docs: DataFrame, model: LineModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                scores = pa.array(model.score(batch.column(1).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    return (
        texts(docs)
        .mapInArrow(run, "doc_id long, score double")
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )


def op7(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with all their columns; the score is taken on the way, without a join."""
    model = train(docs, labels)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                column = batch.column(batch.schema.get_field_index("text"))
                keep = model.score([t or "" for t in column.to_pylist()]) >= THRESHOLD
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
