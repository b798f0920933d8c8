"""Training by full-batch descent, binomial mixtures and scoring.

One step is one pass over packed rows: every task adds up its part of the loss and of the gradient
with NumPy, and the parts are summed in a tree of tasks, by blocks of weights.  The driver gets each
block once, whatever the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.numeric import binomial_log_odds, sigmoid
from tamarack.operators.text import pack_vectors
from tamarack.staging import Stage, broadcast_if_bounded

# Sums of a pass that stand before those of the weights.
LOSS, RESIDUAL, ROWS, SUMS = 0, 1, 2, 3
# Sums that go through the tree together, and parts that one task of it adds up.
BLOCK, FAN_IN = 1 << 16, 32
PART = "part long, block long, sums binary"


@dataclass
class Fit:
    """Weights and the loss after each step."""

    weights: np.ndarray
    losses: list[float] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        """(idx, weight): as many rows as the model has weights."""
        return weight_table(spark, self.weights)


def weight_table(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    rows = [(i, float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, "idx long, weight double")


def blocks_of(sums: np.ndarray) -> pa.RecordBatch:
    """A task's sums, cut into blocks, under the number of the task."""
    starts = range(0, len(sums), BLOCK)
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(starts), pa.int64()),
            pa.array([s // BLOCK for s in starts], pa.int64()),
            pa.array([sums[s : s + BLOCK].tobytes() for s in starts], pa.binary()),
        ],
        names=["part", "block", "sums"],
    )


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the blocks (part, block, sums) that lie next to each other under one part and block."""
    key, total = None, None
    for b in batches:
        for part, block, sums in zip(*(c.to_pylist() for c in b.columns), strict=True):
            here = np.frombuffer(sums)
            if key == (part, block):
                total += here
                continue
            if key is not None:
                yield _block(key, total)
            key, total = (part, block), here.copy()
    if key is not None:
        yield _block(key, total)


def _block(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([total.tobytes()])], names=["part", "block", "sums"])


def summed(parts: DataFrame, tasks: int, size: int) -> np.ndarray:
    """The sum of ``tasks`` vectors of ``size`` numbers, each given in blocks (part, block, sums).

    Levels of tasks add up ``FAN_IN`` parts of a block each, until every block has one part.
    """
    blocks = -(-size // BLOCK)
    while True:
        tasks = -(-tasks // FAN_IN)
        grouped = parts.select(F.expr(f"part div {FAN_IN}").alias("part"), "block", "sums")
        grouped = grouped.repartition(tasks * blocks, "part", "block").sortWithinPartitions("part", "block")
        parts = grouped.mapInArrow(_add_blocks, PART)
        if tasks == 1:
            break
    out = np.zeros(size)
    for row in parts.select("block", "sums").toLocalIterator() if blocks > FAN_IN else parts.select("block", "sums").collect():
        here = np.frombuffer(row["sums"])
        out[row["block"] * BLOCK : row["block"] * BLOCK + len(here)] = here
    return out


def partitions(rows: DataFrame) -> int:
    return max(1, rows.rdd.getNumPartitions())


@contextmanager
def laid_out(rows: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """The rows of many passes, kept by the executors as far as they have room, and their partitions."""
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held, partitions(held)
    finally:
        held.unpersist()


def sparse_rows(features: DataFrame, labels: DataFrame, *, doc: str = "doc_id") -> Stage:
    """Written (doc, label, idx, val) rows: one per document that has a feature and a label."""
    return Stage(pack_vectors(features, doc=doc).join(labels.select(doc, "label"), doc), "training-rows")


class Standardiser:
    """Mean and std per dimension, applied without making zeros explicit.

    With z = (x - mean)/std, r.z = sum over non-zeros of (r/std) x, minus one constant; the gradient
    needs the constant's counterpart, the sum of all residuals.  A dimension with std 0 is inert.
    """

    def __init__(self, mean: np.ndarray, std: np.ndarray):
        self.mean = mean
        self.scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)

    @classmethod
    def identity(cls, size: int) -> "Standardiser":
        return cls(np.zeros(size), np.ones(size))

    @classmethod
    def from_moments(cls, moments: DataFrame, size: int) -> "Standardiser":
        """From (idx, mean, std) rows, at most one per weight."""
        rows = moments.toPandas()
        mean, std = np.zeros(size), np.zeros(size)
        at = rows["idx"].to_numpy()
        mean[at], std[at] = rows["mean"].to_numpy(), rows["std"].to_numpy()
        return cls(mean, std)


def logistic_pass(
    rows: DataFrame, weights: np.ndarray, scaler: Standardiser, reg: float, tasks: int | None = None
) -> tuple[float, np.ndarray]:
    """Mean logistic loss + reg |r|^2 / n, and its gradient, in one pass over packed rows.

    ``tasks`` is the number of partitions of the rows, if known.
    """
    size = len(weights)
    scaled = weights * scaler.scale
    offset = float(scaled @ scaler.mean)

    def add_up(batches):
        sums = np.zeros(SUMS + size)
        grad = sums[SUMS:]
        for b in batches:
            sizes = b.column("idx").value_lengths().to_numpy(zero_copy_only=False)
            idx = b.column("idx").flatten().to_numpy(zero_copy_only=False)
            val = b.column("val").flatten().to_numpy(zero_copy_only=False)
            y = b.column("label").to_numpy(zero_copy_only=False).astype(float)
            row = np.repeat(np.arange(len(y)), sizes)
            theta = np.bincount(row, val * scaled[idx], len(y)) - offset
            e = np.exp(-np.abs(theta))
            residuals = np.where(theta >= 0, 1.0 / (1.0 + e), e / (1.0 + e)) - y
            grad += np.bincount(idx, val * residuals[row], size)
            sums[LOSS] += float(np.sum(np.maximum(theta, 0.0) + np.log1p(e) - y * theta))
            sums[RESIDUAL] += float(residuals.sum())
            sums[ROWS] += len(y)
        yield blocks_of(sums)

    taken = rows.select("label", "idx", "val")
    sums = summed(taken.mapInArrow(add_up, PART), tasks or partitions(taken), SUMS + size)
    n = sums[ROWS]
    full = (sums[SUMS:] - scaler.mean * sums[RESIDUAL]) * scaler.scale
    return (
        float((sums[LOSS] + reg * float(weights @ weights)) / n),
        (full + 2.0 * reg * weights) / n,
    )


def hinge_pass(rows: DataFrame, weights: np.ndarray, c: float, tasks: int | None = None) -> tuple[float, np.ndarray]:
    """Regularised hinge loss and sub-gradient over (label, features) rows; penalty 1/(n c)."""
    size = len(weights)

    def add_up(batches):
        sums = np.zeros(SUMS + size)
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            y = b.column("label").to_numpy(zero_copy_only=False).astype(float)
            slack = 1.0 - y * (x @ weights)
            # A margin of exactly 1 counts as active.
            sums[SUMS:] -= (y * (slack >= 0)) @ x
            sums[LOSS] += float(np.maximum(slack, 0.0).sum())
            sums[ROWS] += len(y)
        yield blocks_of(sums)

    taken = rows.select("label", "features")
    sums = summed(taken.mapInArrow(add_up, PART), tasks or partitions(taken), SUMS + size)
    n = sums[ROWS]
    penalty = 1.0 / (n * c)
    return (
        float(penalty / 2.0 * float(weights @ weights) + sums[LOSS] / n),
        sums[SUMS:] / n + penalty * weights,
    )


def descend(step, start: np.ndarray, *, rate: float, tolerance: float, max_steps: int, before: float | None = None) -> Fit:
    """Gradient descent with a bold driver: halve the rate when the loss rose, else raise it by 10 %.

    ``step(weights)`` gives (loss, gradient).  Stops when the loss moved by no more than the tolerance,
    and fails if ``max_steps`` do not get there; a tolerance of 0 asks for just that many steps.
    ``before`` is the loss to compare the first one with; by default the first step is always taken.
    """
    weights = start.copy()
    loss, grad = step(weights)
    fit = Fit(weights, [loss])
    change = float("inf") if before is None else abs(loss - before)
    while change > tolerance and len(fit.losses) <= max_steps:
        weights = weights - rate * grad
        new_loss, grad = step(weights)
        change = abs(new_loss - loss)
        rate *= 0.5 if new_loss > loss else 1.1
        loss = new_loss
        fit.losses.append(loss)
    if tolerance > 0 and change > tolerance:
        raise RuntimeError(f"the loss still moves by {change} after {max_steps} steps")
    fit.weights = weights
    return fit


def train_logistic(
    rows: DataFrame,
    *,
    size: int,
    scaler: Standardiser | None = None,
    start: np.ndarray | None = None,
    reg: float = 0.0,
    rate: float = 0.1,
    tolerance: float = 1e-5,
    max_steps: int = 10_000,
) -> Fit:
    """Logistic regression on packed rows with labels 0/1."""
    used = scaler or Standardiser.identity(size)
    first = np.zeros(size) if start is None else start
    with laid_out(rows) as (held, tasks):
        return descend(
            lambda w: logistic_pass(held, w, used, reg, tasks), first, rate=rate, tolerance=tolerance, max_steps=max_steps
        )


def train_logistic_warm(rows: DataFrame, sample: DataFrame, **options) -> Fit:
    """Train on a sample first, then on everything from the weights found."""
    first = train_logistic(sample, **options)
    return train_logistic(rows, start=first.weights, **options)


def train_svm(
    rows: DataFrame,
    *,
    size: int,
    c: float,
    start: np.ndarray | None = None,
    rate: float = 1.0,
    tolerance: float = 1e-3,
    max_steps: int = 10_000,
) -> Fit:
    """Linear SVM on (label +1/-1, features) rows."""
    first = np.zeros(size) if start is None else start
    with laid_out(rows) as (held, tasks):
        before = hinge_pass(held, first + 1.0, c, tasks)[0]
        return descend(
            lambda w: hinge_pass(held, w, c, tasks), first, rate=rate, tolerance=tolerance, max_steps=max_steps, before=before
        )


def sparse_scores(
    features: DataFrame, weights: DataFrame, *, size: int, offset: float = 0.0, doc: str = "doc_id"
) -> DataFrame:
    """(doc, score): sum of value * weight over a document's entries, minus an offset."""
    joined = features.join(broadcast_if_bounded(weights, size), "idx")
    return joined.groupBy(doc).agg((F.sum(F.col("value") * F.col("weight")) - F.lit(offset)).alias("score"))


def standardised_weights(spark: SparkSession, weights: np.ndarray, scaler: Standardiser) -> tuple[DataFrame, float]:
    """Weights and offset that score raw features as the standardised ones would be."""
    scaled = weights * scaler.scale
    return weight_table(spark, scaled), float(scaled @ scaler.mean)


def predict_above(scores: DataFrame, *, cutoff: float) -> DataFrame:
    """1 where the raw score is strictly above the cutoff, else 0."""
    return scores.withColumn("predicted", F.when(F.col("score") > cutoff, 1).otherwise(0))


def probability(score: Column) -> Column:
    return sigmoid(score)


def indicative_words(weights: DataFrame, vocab: DataFrame, *, n: int = 50) -> DataFrame:
    """(idx, word, weight) of the n largest signed weights."""
    named = weights.join(vocab.select("word", "idx"), "idx")
    return named.orderBy(F.col("weight").desc(), "idx").limit(n).select("idx", "word", "weight")


def em_binomial(observations: DataFrame, *, start: tuple[float, float] = (0.79, 0.51), steps: int = 20) -> DataFrame:
    """(step, p1, p2): EM for two binomial coins with equal odds over (k, n) observations.

    Observations are reduced to counts per (n, k) first; a step is one aggregate over those.
    """
    counted = observations.groupBy("n", "k").agg(F.count("*").alias("w"))
    stats = Stage(counted, "flips")
    k, n, w = F.col("k"), F.col("n"), F.col("w")
    p1, p2 = start
    trace = []
    for step in range(1, steps + 1):
        gap = binomial_log_odds(p1, p2)
        first = w * sigmoid(k * gap[0] + (n - k) * gap[1])
        sums = stats.df.agg(F.sum(first * k), F.sum(first * n), F.sum((w - first) * k), F.sum((w - first) * n)).first()
        heads1, flips1, heads2, flips2 = sums
        p1 = float(heads1 / flips1) if flips1 else p1
        p2 = float(heads2 / flips2) if flips2 else p2
        trace.append((step, p1, p2))
    stats.drop()
    return observations.sparkSession.createDataFrame(trace, "step long, p1 double, p2 double")
