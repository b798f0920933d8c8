"""Queries on a text model trained to its tolerance, against a fit in NumPy on a small folder of documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tamarack.operators import models, sampling
from tamarack.plans import learning as plan

TOLERANCE = 1e-5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfgklmnp" for b in ("a", "e", "i", "oo", "un")]
    docs = []
    for i in range(70):
        source = f"src{rng.choice([0, 1, 2, 3, 10, 5])}"
        own = words[:20] if "src1" in source else words[15:]
        text = " ".join(rng.choice(own if rng.random() < 0.5 else words) + rng.choice(["", ",", "-", " 7"]) for _ in range(rng.randrange(5, 30)))
        docs.append((i * 3, text.title() if i % 4 == 0 else text, source))
    docs += [(500, "", "src1"), (501, "12 34", "src2")]
    path = str(tmp_path_factory.mktemp("fitted"))
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{path}/documents.parquet")
    return path, docs


class Model:
    """Statistics of some documents, and the dense rows of any under them."""

    def __init__(self, docs):
        said = {d: [w.lower() for w in re.findall("[a-zA-Z]+", t)] for d, t, _ in docs}
        counts = Counter(w for ws in said.values() for w in ws)
        self.words = sorted(counts, key=lambda w: (-counts[w], w))
        self.at = {w: i for i, w in enumerate(self.words)}
        holding = Counter(w for ws in said.values() for w in set(ws))
        self.idf = np.array([math.log(len(docs) / holding[w]) for w in self.words])
        raw = self.raw(docs)
        values = np.array(list(raw.values()))
        self.mean, self.std = values.mean(axis=0), values.std(axis=0)

    def raw(self, docs):
        out = {}
        for d, t, _ in docs:
            row = np.zeros(len(self.words))
            for w in re.findall("[a-zA-Z]+", t):
                if w.lower() in self.at:
                    row[self.at[w.lower()]] += 1
            if row.sum():
                out[d] = row / row.sum() * self.idf
        return out

    def rows(self, docs):
        scale = np.where(self.std > 1e-12, 1 / np.maximum(self.std, 1e-12), 0)
        return {d: (r - self.mean) * scale for d, r in self.raw(docs).items()}


def fit(x, y, start, copies=None):
    """Descent by the bold driver until the loss moves by no more than the tolerance."""
    copies = np.ones(len(y)) if copies is None else copies

    def step(w):
        theta = x @ w
        loss = (copies * (np.logaddexp(0, theta) - y * theta)).sum() / copies.sum()
        return loss, x.T @ (copies * (1 / (1 + np.exp(-theta)) - y)) / copies.sum()

    w, rate = start.copy(), 0.1
    loss, grad = step(w)
    losses = [loss]
    while True:
        w = w - rate * grad
        new, grad = step(w)
        rate *= 0.5 if new > loss else 1.1
        losses.append(new)
        if abs(new - loss) <= TOLERANCE:
            return w, losses
        loss = new


@pytest.fixture(scope="module")
def fitted(folder):
    _, docs = folder
    model = Model(docs)
    rows = model.rows(docs)
    ids = sorted(rows)
    label = {d: int("src1" in s) for d, _, s in docs}
    x, y = np.array([rows[d] for d in ids]), np.array([label[d] for d in ids], float)
    weights, losses = fit(x, y, np.zeros(x.shape[1]))
    return model, ids, x, y, weights, losses


def run(spark, folder, name):
    return entry.queries()[name](spark, folder[0]).collect()


def test_fit_reaches_the_tolerance(spark, folder, fitted):
    _, _, _, _, weights, losses = fitted
    assert len(losses) > 20
    got = sorted(run(spark, folder, "logistic_descent"))
    assert [r[0] for r in got] == list(range(len(weights)))
    assert np.allclose([r[1] for r in got], weights, atol=1e-7)
    got = sorted(run(spark, folder, "logistic_losses"))
    assert len(got) == len(losses) and np.allclose([r[1] for r in got], losses, atol=1e-8)


def test_warm_start_goes_on_to_the_tolerance(spark, folder, fitted):
    _, ids, x, y, _, _ = fitted
    keyed = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    drawn = sampling.poisson_sample(keyed, ids=["doc_id"], fraction=plan.SAMPLE_FRACTION, seed=plan.SAMPLE_SEED)
    copies = Counter(r.doc_id for r in drawn.collect())
    first, _ = fit(x, y, np.zeros(x.shape[1]), np.array([float(copies[i]) for i in ids]))
    weights, _ = fit(x, y, first)
    got = sorted(run(spark, folder, "logistic_warm_start"))
    assert np.allclose([r[1] for r in got], weights, atol=1e-7)


def test_words_scores_and_metrics_of_the_fit(spark, folder, fitted, monkeypatch):
    model, ids, x, y, weights, _ = fitted
    # The four queries fit the same model; it is trained for the first of them.
    train, done = plan.TextTask.fit, []
    monkeypatch.setattr(plan.TextTask, "fit", lambda task: done[0] if done else done.append(train(task)) or done[0])
    order = sorted(range(len(weights)), key=lambda i: (-round(weights[i], 9), i))[:50]
    got = run(spark, folder, "indicative_words")
    assert [r.word for r in got] == [model.words[i] for i in order]
    theta = x @ weights
    got = {r.doc_id: r for r in run(spark, folder, "threshold_scores")}
    assert sorted(got) == ids
    assert np.allclose([got[i].score for i in ids], theta, atol=1e-6)
    assert [got[i].predicted for i in ids] == [int(t > plan.CUTOFF) for t in theta]
    found = theta > plan.CUTOFF
    wrong = sorted((i for i, f, label in zip(ids, found, y) if f and not label), reverse=True)[:10]
    assert [r.doc_id for r in run(spark, folder, "false_positives")] == wrong
    assert run(spark, folder, "classification_metrics")[0] == pytest.approx(rated(found, y))


def rated(found, y):
    hits = float((found & (y == 1)).sum())
    precision, recall = hits / found.sum(), hits / (y == 1).sum()
    right = float((found == (y == 1)).sum())
    return len(y), right, right / len(y), precision, recall, 2 * precision * recall / (precision + recall)


def test_unseen_texts_are_scored_by_the_written_model(spark, folder, tmp_path):
    _, docs = folder
    held = {r[0] for r in spark.createDataFrame([(d[0],) for d in docs], "doc_id long").filter(plan.unseen()).collect()}
    known, new = [d for d in docs if d[0] not in held], [d for d in docs if d[0] in held]
    model = Model(known)
    rows = model.rows(known)
    label = {d: int("src1" in s) for d, _, s in docs}
    weights, _ = fit(np.array([rows[d] for d in sorted(rows)]), np.array([float(label[d]) for d in sorted(rows)]), np.zeros(len(model.words)))
    unseen = model.rows(new)
    theta = np.array([unseen[d] @ weights for d in sorted(unseen)])
    expected = rated(theta > plan.CUTOFF, np.array([label[d] for d in sorted(unseen)]))
    assert len(unseen) >= 5 and run(spark, folder, "unseen_metrics")[0] == pytest.approx(expected)

    table = [(w, i, float(model.idf[i]), float(model.mean[i]), float(model.std[i] if model.std[i] > 1e-12 else 0), float(weights[i])) for w, i in model.at.items()]
    models.save_model(spark.createDataFrame(table, models.COLUMNS), str(tmp_path / "model"))
    loaded = models.load_model(spark, str(tmp_path / "model"))
    frame = spark.createDataFrame(new, "doc_id long, text string, source string")
    got = {r.doc_id: r.score for r in models.score_texts(loaded, frame, size=len(table)).collect()}
    assert got == pytest.approx({d: float(t) for d, t in zip(sorted(unseen), theta)}, abs=1e-9)
