"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w·x - t_k) with weights shared by all grades and ordered thresholds t_0 < t_1 < t_2; the expected
severity is the sum of these over k.  A feature counts a document's different words by the word itself and by its
beginnings (so inflected forms share weight), hashed into a fixed number of slots.

Only slots that tell toxic rows from others are fitted: those whose likelihood ratio against independence is above
``TELLING`` and that ``SEEN`` sampled documents hold.

Labels say toxic or not.  Grades of the toxic rows come from the rows themselves: the number of their different
words that are far more common among toxic rows, cut at its terciles, gives 1, 2 or 3.

The fit uses at most ``SAMPLE_DOCS`` labelled documents, none held out; every document is scored, whole.

Defined cases: null and empty texts have no features; without labelled rows of both kinds every severity is the rate of
toxic rows (0 without any); repeated rows give repeated results; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import texts
from tamarack.llm.labelled import held_out, training_rows

SAMPLE_DOCS = 8_000
SLOTS = 1 << 18
BEGINNINGS = (4, 5, 6)
TELLING, SEEN = 8.0, 3
GRADES = 3  # above 0
REMEMBERED = 1 << 18
ROWS = 512
EDGES = ".,;:!?\"'()[]{}|*#$%&-"


def words_of(text: str) -> set[str]:
    """Different words, lower case, without punctuation around them."""
    return {w.strip(EDGES) for w in text.lower().split()} - {""}


def slots_of(word: str) -> list[int]:
    """The word's slots: itself and its beginnings."""
    keys = [word, *(f"{n}^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % SLOTS for k in keys]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class SeverityModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds
        self.memory: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "thresholds": self.thresholds, "memory": {}}

    def link(self, text: str) -> float:
        """w·x of a text."""
        memory, total = self.memory, 0.0
        # Sorted sums would cost more than they are worth: rounding to 9 digits makes the order of a set harmless.
        for word in words_of(text):
            value = memory.get(word)
            if value is None:
                value = float(self.weights[slots_of(word)].sum(dtype=np.float64))
                if len(memory) >= REMEMBERED:
                    memory.clear()
                memory[word] = value
            total += value
        return round(total, 9)

    def above(self, links: np.ndarray) -> np.ndarray:
        """P(grade > k) per text and k."""
        return _sigmoid(links[:, None] - self.thresholds)


def grades(documents: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades of documents, given as slots of their words themselves: 0 where not toxic, else 1 to 3."""
    flat = np.concatenate(documents) if documents else np.zeros(0, dtype=np.int64)
    owner = np.repeat(toxic, [len(d) for d in documents])
    bad = np.bincount(flat[owner == 1], minlength=SLOTS) / max(1, int((toxic == 1).sum()))
    fine = np.bincount(flat[owner == 0], minlength=SLOTS) / max(1, int((toxic == 0).sum()))
    marked = (bad > 8 * fine + 2 / max(1, int((toxic == 1).sum()))) & (bad > 0)
    count = np.array([int(marked[d].sum()) for d in documents])
    cuts = np.quantile(count[toxic == 1], [1 / 3, 2 / 3]) if (toxic == 1).any() else [0, 0]
    return np.where(toxic == 1, 1 + (count > cuts[0]).astype(int) + (count > cuts[1]).astype(int), 0)


def telling(documents: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Whether each slot tells toxic documents from others (a G-test)."""
    held = [np.unique(d) for d in documents]
    owner = np.repeat(toxic, [len(d) for d in held])
    flat = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
    n = [float((toxic == t).sum()) for t in (0, 1)]
    ratio = np.zeros(SLOTS)
    with_slot = [np.bincount(flat[owner == t], minlength=SLOTS).astype(float) for t in (0, 1)]
    share = (with_slot[0] + with_slot[1]) / max(1.0, sum(n))
    for t in (0, 1):
        for seen, expected in ((with_slot[t], n[t] * share), (n[t] - with_slot[t], n[t] * (1 - share))):
            ratio += np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    return (ratio > TELLING) & (with_slot[0] + with_slot[1] >= SEEN)


def likelihood(links: np.ndarray, thresholds: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cumulative-link log likelihood log(s(t_g - x) - s(t_(g-1) - x)) of each row's grade g, where s is the sigmoid and the
    thresholds go from minus to plus infinity; its slopes by the link x, and by the thresholds (row, threshold)."""
    rows = np.arange(len(grade))
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    high, low = edges[grade + 1] - links, edges[grade] - links
    gap = -np.expm1(edges[grade] - edges[grade + 1])  # 1 where one of them is infinite
    up, down = _sigmoid(high), _sigmoid(low)
    # s(a) - s(b) = s(a) s(-b) (1 - exp(b - a)), which keeps its digits at both ends.
    value = np.log(up) + np.log(_sigmoid(-low)) + np.log(gap)
    by_threshold = np.zeros((len(grade), len(edges)))
    by_threshold[rows, grade + 1] = _sigmoid(-high) / (_sigmoid(-low) * gap)
    by_threshold[rows, grade] = -down / (up * gap)
    return value, up + down - 1, by_threshold[:, 1:-1]


def ordered(gaps: np.ndarray) -> np.ndarray:
    """Thresholds by the first one and the logs of the steps up."""
    return np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])


def fit(documents: list[np.ndarray], grade: np.ndarray, *, rounds: int = 150, rate: float = 0.05, ridge: float = 1e-4) -> SeverityModel:
    """Maximum of the mean cumulative-link likelihood, less ridge/2 of the squared weights, by Adam over all rows;
    ``documents``: each one's slots, repeats included."""
    rate_of_toxic = float((grade > 0).mean()) if len(grade) else 0.0
    if not 0 < rate_of_toxic < 1:
        level = np.log(np.clip(rate_of_toxic, 1e-9, 1 - 1e-9) / (1 - np.clip(rate_of_toxic, 1e-9, 1 - 1e-9)))
        return SeverityModel(np.zeros(SLOTS), np.full(GRADES, -level))
    flat = np.concatenate(documents)
    row = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    used, at = np.unique(flat, return_inverse=True)
    weights, gaps = np.zeros(len(used)), np.array([1.0, 0.0, 0.0])  # thresholds: the first, then logs of the steps up
    first, second = np.zeros(len(used) + GRADES), np.zeros(len(used) + GRADES)
    n = len(grade)
    for k in range(1, rounds + 1):
        links = np.bincount(row, weights=weights[at], minlength=n)
        _, by_link, by_threshold = likelihood(links, ordered(gaps), grade)
        up = np.bincount(at, weights=by_link[row], minlength=len(used)) / n - ridge * weights
        moved = by_threshold.mean(axis=0)
        # A step up moves its threshold and all above it.
        slope = np.concatenate([up, [moved.sum()], np.cumsum(moved[::-1])[::-1][1:] * np.exp(gaps[1:])])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        weights, gaps = weights + move[: len(used)], gaps + move[len(used) :]
    whole = np.zeros(SLOTS)
    whole[used] = weights
    return SeverityModel(whole, ordered(gaps))


def train(docs: DataFrame, labels: DataFrame, *, most: int = SAMPLE_DOCS) -> SeverityModel:
    """Fit on the sample; its slots, not its texts, come to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[slots_of(w) for w in sorted(words_of(t))] for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "words": [np.array([s[0] for s in f], dtype=np.int32).tobytes() for f in found],
                    "slots": [np.array([x for s in f for x in s], dtype=np.int32).tobytes() for f in found],
                }
            )

    got = training_rows(texts(docs), labels, "toxic", most).mapInPandas(run, "doc_id long, label int, words binary, slots binary").toPandas()
    got = got.sort_values(["doc_id", "label", "words"], ignore_index=True)
    toxic = got["label"].to_numpy()
    words = [np.frombuffer(x, np.int32) for x in got["words"]]
    slots = [np.frombuffer(x, np.int32) for x in got["slots"]]
    kept = telling(slots, toxic)
    return fit([s[kept[s]] for s in slots], grades(words, toxic) if len(got) else toxic)


def severities(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """(doc_id, severity, score) of all documents: the expected grade, and the probability of any grade above 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                above = fitted.above(np.array([fitted.link(t) for t in batch.column(1).to_pylist()], dtype=np.float64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0])], names=["doc_id", "severity", "score"]
                )

    return texts(docs).mapInArrow(run, "doc_id long, severity double, score double")


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return severities(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "severity", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
