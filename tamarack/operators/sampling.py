"""Reproducible samples and splits."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.hashing import KEY_BITS, sample_key, sample_uniform
from tamarack.operators.ordering import global_index
from tamarack.operators.selection import key_at_rank, keys_at_ranks
from tamarack.staging import broadcast_if_bounded, written

RANGE_BITS = 14


def poisson_steps(fraction: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, up to the last one that differs from 1."""
    # Masses by their logarithms, as those of a large fraction begin below the smallest double.
    steps, cumulative, log_mass = [], 0.0, -fraction
    while True:
        mass, k = math.exp(log_mass), len(steps)
        if cumulative + mass >= 1.0 - 1e-15 or (k > fraction and mass < 1e-17):
            return steps
        cumulative += mass
        steps.append(cumulative)
        log_mass += math.log(fraction / (k + 1))


def poisson_sample(df: DataFrame, *, ids: list[str], fraction: float, seed: int) -> DataFrame:
    """Sample with replacement: each row appears Poisson(fraction) times.

    The number of copies is read off the Poisson distribution at the row's own uniform key.
    """
    u = sample_uniform(seed, *[F.col(c) for c in ids])
    copies = F.size(F.filter(F.array(*[F.lit(s) for s in poisson_steps(fraction)]), lambda s: s <= F.col("_u")))
    return (
        df.withColumn("_u", u)
        .withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*df.columns)
    )


def sample_exact(
    df: DataFrame, *, n: int, ids: list[str], seed: int, by: str | None = None, order: str = "sample_order"
) -> DataFrame:
    """Exactly ``n`` rows per class without replacement (all rows of a smaller class).

    Takes the n smallest keys of a class and numbers them 1..n in ``order``.  A first pass counts
    keys per class in 2^14 ranges; only rows up to the range where the class reaches n are sorted,
    so a class that holds most of the data costs one count and a sort of about n rows.
    """
    by_cols = [by] if by else []
    keyed = df.withColumn("_key", sample_key(seed, *[F.col(c) for c in ids])).withColumn(
        "_range", F.shiftright("_key", KEY_BITS - RANGE_BITS)
    )
    counts = keyed.groupBy(*by_cols, "_range").agg(F.count("*").alias("_c"))
    # At most 2^RANGE_BITS rows per class.
    before = F.sum("_c").over(Window.partitionBy(*by_cols).orderBy("_range")) - F.col("_c")
    needed = counts.withColumn("_before", before).filter(F.col("_before") < n).drop("_c")
    # Written, so that its true size lets the planner broadcast it and leave the rows in place.
    needed = written(needed.select(*[F.col(c).alias(f"_of_{c}") for c in by_cols], F.col("_range").alias("_r"), "_before"), "sample-ranges")
    same = F.col("_range") == F.col("_r")
    for c in by_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = keyed.join(needed, same)
    # Sorting inside a key range, then adding what lies before it, needs no wide class partition.
    place = F.row_number().over(Window.partitionBy(*by_cols, "_range").orderBy("_key", *ids)) + F.col("_before")
    return joined.withColumn(order, place).filter(F.col(order) <= n).select(*df.columns, order)


def hold_out_last(df: DataFrame, *, n: int, order: str, by: str | None = None, split: str = "split") -> DataFrame:
    """Mark the last ``n`` rows per class in ``order`` as 'test', the others as 'train'.

    Meant for samples of bounded size per class, as ``sample_exact`` gives.
    """
    w = Window.partitionBy(*([by] if by else [])).orderBy(F.col(order).desc())
    return df.withColumn(split, F.when(F.row_number().over(w) <= n, "test").otherwise("train"))


def prefix_split(df: DataFrame, *, row_id: str, n: int, split: str = "split") -> DataFrame:
    """Rows 0..n-1 of an explicit row order are 'train', the rest 'test'."""
    return df.withColumn(split, F.when(F.col(row_id) < n, "train").otherwise("test"))


def draw_batch(df: DataFrame, *, size: int, ids: list[str], seed: int) -> DataFrame:
    """``size`` rows drawn with replacement, each row with equal odds; ``draw`` numbers the draws.

    A draw picks a place in the order of ``ids``.  By a single integer id the rows of those places are found by counting,
    and nothing but the drawn rows is kept; by other ids the table is numbered.
    """
    n = df.count()
    if n == 0:
        return df.limit(0).select(F.lit(0).cast("long").alias("draw"), *df.columns)
    draws = df.sparkSession.range(size).select(
        F.col("id").alias("draw"), F.floor(sample_uniform(seed, F.col("id")) * n).alias("_i")
    )
    if len(ids) == 1 and df.schema[ids[0]].dataType.typeName() in ("byte", "short", "integer", "long"):
        places = draws.select(F.col("_i").alias("rank")).distinct()
        at = keys_at_ranks(df.select(*ids), ids[0], places).select(F.col("rank").alias("_i"), F.col(ids[0]).alias("_key"))
        keyed = draws.join(at, "_i").select("draw", "_key")
        return df.join(broadcast_if_bounded(keyed, size), F.col(ids[0]) == F.col("_key")).select("draw", *df.columns)
    indexed = global_index(df, ids, index="_i")
    return indexed.join(broadcast_if_bounded(draws, size), "_i").select("draw", *df.columns)


def split_before_rank(df: DataFrame, *, key: str, n: int, split: str = "split") -> DataFrame:
    """The ``n`` rows of the smallest unique keys are 'train', the rest 'test'; only the key that parts them is looked for."""
    parting = key_at_rank(df, key, n)
    first = F.lit(True) if parting is None else F.col(key) < F.lit(parting)
    return df.withColumn(split, F.when(first, "train").otherwise("test"))


def shuffled(df: DataFrame, *, ids: list[str], seed: int) -> DataFrame:
    """Rows in a seeded random order."""
    return df.orderBy(sample_key(seed, *[F.col(c) for c in ids]), *ids)
