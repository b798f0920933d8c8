import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tamarack.functions.numeric import clip01, hinge, ratio_or_zero, sigmoid, softplus
from tamarack.operators import learning, metrics
from tamarack.sources.generators import coin_flips

RNG = np.random.default_rng(3)
DENSE = RNG.random((60, 12)) * (RNG.random((60, 12)) < 0.3)
DENSE[:, 5] = 0.0
DENSE[:, 6] = 0.25
LABELS = (RNG.random(60) < 0.4).astype(int)


def sparse_rows(spark):
    data = [(i, j, float(DENSE[i, j])) for i in range(60) for j in range(12) if DENSE[i, j]]
    features = spark.createDataFrame(data, "doc_id long, idx long, value double")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(LABELS)], "doc_id long, label int")
    return features, labels


def standard():
    mean, std = DENSE.mean(0), DENSE.std(0)
    safe = np.where(std > 0, std, 1)
    return mean, std, np.where(std > 0, (DENSE - mean) / safe, 0.0)


def logistic(z, y, r, reg):
    theta = z @ r
    loss = (np.sum(np.logaddexp(0, theta) - y * theta) + reg * r @ r) / len(y)
    grad = (z.T @ (1 / (1 + np.exp(-theta)) - y) + 2 * reg * r) / len(y)
    return loss, grad


def test_logistic_pass_matches_dense_without_densifying(spark):
    mean, std, z = standard()
    features, labels = sparse_rows(spark)
    table = learning.sparse_rows(features, labels).df
    r = RNG.normal(size=12)
    loss, grad = learning.logistic_pass(table.repartition(5), r, learning.Standardiser(mean, std), 0.7)
    expected = logistic(z, LABELS, r, 0.7)
    assert math.isclose(loss, expected[0]) and np.allclose(grad, expected[1])
    assert grad[5] == 2 * 0.7 * r[5] / 60


def bold(step, w, rate, tolerance, limit, change=float("inf")):
    loss, grad = step(w)
    losses = [loss]
    while change > tolerance and len(losses) <= limit:
        w = w - rate * grad
        new, grad = step(w)
        change, rate, loss = abs(new - loss), rate * (0.5 if new > loss else 1.1), new
        losses.append(new)
    return w, losses


@pytest.mark.parametrize("rate", [0.1, 40.0])
def test_training_follows_the_bold_driver(spark, rate):
    mean, std, z = standard()
    table = learning.sparse_rows(*sparse_rows(spark)).df
    fit = learning.train_logistic(
        table, size=12, scaler=learning.Standardiser(mean, std), reg=0.1, rate=rate, tolerance=1e-3, max_steps=500
    )
    w, losses = bold(lambda r: logistic(z, LABELS, r, 0.1), np.zeros(12), rate, 1e-3, 500)
    assert 2 < len(losses) < 500
    assert len(fit.losses) == len(losses) and np.allclose(fit.weights, w) and np.allclose(fit.losses, losses)


def test_training_that_does_not_settle_is_an_error(spark):
    table = learning.sparse_rows(*sparse_rows(spark)).df
    with pytest.raises(RuntimeError, match="after 3 steps"):
        learning.train_logistic(table, size=12, tolerance=1e-9, max_steps=3)


def test_blocks_of_many_tasks_are_summed_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(learning, "BLOCK", 4)
    monkeypatch.setattr(learning, "FAN_IN", 3)
    parts = [(t, b, np.arange(b * 4, min(b * 4 + 4, 10)) * float(t + 1)) for t in range(11) for b in range(3)]
    df = spark.createDataFrame([(t, b, v.astype(float).tobytes()) for t, b, v in parts], learning.PART).repartition(5)
    assert np.allclose(learning.summed(df, 11, 10), np.arange(10) * 66.0)


def test_warm_start_begins_where_the_sample_ended(spark):
    table = learning.sparse_rows(*sparse_rows(spark)).df
    options = dict(size=12, tolerance=0.0, max_steps=2)
    sample = table.filter("doc_id < 20")
    first = learning.train_logistic(sample, **options)
    warm = learning.train_logistic_warm(table, sample, **options)
    again = learning.train_logistic(table, start=first.weights, **options)
    assert np.allclose(warm.weights, again.weights)


def test_scores_cutoff_and_indicative_words(spark):
    mean, std, z = standard()
    features, _ = sparse_rows(spark)
    r = RNG.normal(size=12)
    weights, offset = learning.standardised_weights(spark, r, learning.Standardiser(mean, std))
    got = dict(rows(learning.sparse_scores(features, weights, size=12, offset=offset)))
    assert all(math.isclose(got[i], (z @ r)[i], abs_tol=1e-9) for i in got)
    scores = spark.createDataFrame([(1, 0.6), (2, 0.61), (3, -1.0)], "doc_id long, score double")
    assert rows(learning.predict_above(scores, cutoff=0.6).select("doc_id", "predicted")) == [(1, 0), (2, 1), (3, 0)]
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, idx long")
    table = learning.weight_table(spark, np.array([0.5, -9.0, 0.5]))
    assert [tuple(x) for x in learning.indicative_words(table, vocab, n=2).collect()] == [(0, "a", 0.5), (2, "c", 0.5)]


def svm(x, y, w, c):
    n = len(y)
    slack = 1 - y * (x @ w)
    return (
        w @ w / (2 * n * c) + np.maximum(slack, 0).mean(),
        w / (n * c) - ((y * (slack >= 0)) @ x) / n,
    )


def test_svm_matches_dense_and_margin_one_is_active(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 3))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=50) > 0, 1, -1)
    df = spark.createDataFrame([(int(b), [float(v) for v in a]) for a, b in zip(x, y)], "label int, features array<double>")
    start = np.zeros(3)
    change = abs(svm(x, y, start, 0.5)[0] - svm(x, y, start + 1, 0.5)[0])
    w, losses = bold(lambda v: svm(x, y, v, 0.5), start, 1.0, 1e-3, 200, change)
    fit = learning.train_svm(df.repartition(3), size=3, c=0.5, max_steps=200)
    assert np.allclose(fit.weights, w) and np.allclose(fit.losses, losses)
    one = spark.createDataFrame([(1, [1.0, 0.0])], "label int, features array<double>")
    loss, grad = learning.hinge_pass(one, np.array([1.0, 0.0]), 1.0)
    assert loss == 0.5 and list(grad) == [0.0, 0.0]


def em(k, n, p, steps):
    out = []
    p1, p2 = p
    for _ in range(steps):
        a, b = p1**k * (1 - p1) ** (n - k), p2**k * (1 - p2) ** (n - k)
        c = a / (a + b)
        p1, p2 = (c @ k) / (c @ n), ((1 - c) @ k) / ((1 - c) @ n)
        out.append((p1, p2))
    return out


def test_em_follows_its_formulas(spark):
    flips = coin_flips(spark, seed=2).unionByName(spark.createDataFrame([(900, 0, 10), (901, 10, 10)], "id long, k long, n long"))
    data = flips.toPandas()
    expected = em(data["k"].to_numpy(float), data["n"].to_numpy(float), (0.79, 0.51), 20)
    got = [(r["p1"], r["p2"]) for r in learning.em_binomial(flips).orderBy("step").collect()]
    assert np.allclose(got, expected)
    assert abs(got[-1][0] - got[-2][0]) < 1e-3 and got[-1][0] > got[-1][1]


def test_descent_that_does_not_settle_fails():
    with pytest.raises(RuntimeError, match="still moves"):
        learning.descend(lambda w: (float(w @ w), 2 * w), np.ones(2), rate=0.01, tolerance=1e-12, max_steps=3)


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 0.0), (-1, 0.0), (-1, -1.0), (-1, 3.0)], "label int, score double")
    m = metrics.margin_metrics(df).first()
    assert (m["n"], m["n_correct"], m["precision"], m["recall"], m["f1"]) == (5, 2, 0.5, 0.5, 0.5)
    none = metrics.margin_metrics(df.filter("score < 0")).first()
    assert none["precision"] is None and none["recall"] is None and none["f1"] is None and none["accuracy"] == 1.0
    flags = spark.createDataFrame([(9, 0, 1), (8, 1, 1), (7, 0, 1), (6, 0, 0)], "id int, label int, predicted int")
    assert [r[0] for r in metrics.false_positives(flags, identity="id", n=5).collect()] == [9, 7]
    f = metrics.flag_metrics(flags).first()
    assert (f["precision"], f["recall"], f["accuracy"]) == (1 / 3, 1.0, 0.5)


def test_prediction_quality(spark):
    df = spark.createDataFrame(
        [(1, [0.1, 0.9, 0.9]), (2, [-1.0, -2.0, -0.5]), (0, [800.0, 1.0, 1.0])], "label int, scores array<double>"
    )
    q = metrics.prediction_quality(df).first()
    expected = np.mean([
        -0.9 + np.log(np.exp([0.1, 0.9, 0.9]).sum()),
        0.5 + np.log(np.exp([-1.0, -2.0, -0.5]).sum()),
        0.0,
    ])
    assert (q["n"], q["n_correct"]) == (3, 2) and math.isclose(q["loss"], expected)


def test_numeric_functions_do_not_overflow(spark):
    df = spark.createDataFrame([(1000.0,), (-1000.0,), (0.0,)], "t double")
    got = df.select(softplus(F.col("t")), sigmoid(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(1000.0, 1.0), (0.0, 0.0), (math.log(2), 0.5)]
    other = spark.createDataFrame([(3, 1.0, 0.0), (0, 1.0, 2.0)], "n int, a double, b double")
    assert rows(other.select(clip01(F.col("n")), ratio_or_zero(F.col("a"), F.col("b")))) == [(0, 0.5), (1, 0.0)]
    assert df.select(hinge(F.lit(1), F.col("t"))).first()[0] == 0.0
