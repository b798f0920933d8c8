"""Order-dependent operators without a single-partition sort.

A global order is cut into range slices.  Per-slice totals (one row per slice) give each slice its
offset, and the rest of the work stays inside a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.staging import Stage, parallelism, written

# Positions, and then blocks, that make up a block of the next level of sums.
RADIX = 16


def _slices(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with ``_slice``: all rows of a slice sort before those of the next one."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))
    sliced = df.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id())
    # Written, so that both passes over the slices see the same cut.
    return written(sliced, "slices")


def running_totals(df: DataFrame, order: list[str | Column], totals: dict[str, str]) -> DataFrame:
    """Add inclusive running sums over the global order: {new column: summed column}.

    The order has to be unique for a defined result.
    """
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    sliced = _slices(df, columns)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so the ordered window below has as many rows as there are slices.
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(c).alias(f"_t_{new}") for new, c in totals.items()])
        .select("_slice", *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in totals])
    )
    inside = Window.partitionBy("_slice").orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    joined = sliced.join(F.broadcast(offsets), "_slice")
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"_o_{new}")).alias(new) for new, c in totals.items()],
    )


def global_index(df: DataFrame, order: list[str | Column], *, index: str = "row_index") -> DataFrame:
    """Dense 0, 1, 2, ... in the given unique order: an unpartitioned row number that scales."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, {"_nth": "_one"})
    return counted.select((F.col("_nth") - 1).alias(index), *df.columns)


def sliding_windows(
    df: DataFrame, *, key: str, value: str, width: int, descending: bool = True, bucket: int = 65_536
) -> DataFrame:
    """Total of ``value`` over each run of ``width`` consecutive distinct keys.

    One output row per complete run: (first_key, last_key, total).  ``df`` has one row per key.
    Runs are computed in buckets of the global index; the first ``width - 1`` rows of a bucket are
    also handed to the bucket before it, so no run is lost at a border.
    """
    bucket = max(bucket, width)
    order = F.col(key).desc() if descending else F.col(key).asc()
    indexed = global_index(df.select(key, value), [order], index="_i").withColumn(
        "_home", F.floor(F.col("_i") / bucket)
    )
    spill = (F.col("_i") % bucket < width - 1) & (F.col("_home") > 0)
    copies = F.when(spill, F.array(F.col("_home"), F.col("_home") - 1)).otherwise(F.array("_home"))
    frame = Window.partitionBy("_bucket").orderBy("_i").rowsBetween(0, width - 1)
    runs = indexed.withColumn("_bucket", F.explode(copies)).select(
        "_home",
        "_bucket",
        F.col(key).alias("first_key"),
        F.last(key).over(frame).alias("last_key"),
        F.sum(value).over(frame).alias("total"),
        F.count(F.lit(1)).over(frame).alias("_n"),
    )
    complete = (F.col("_bucket") == F.col("_home")) & (F.col("_n") == width)
    return runs.filter(complete).select("first_key", "last_key", "total")


def _run(first: Column, end: Column) -> Column:
    """first, ..., end - 1 as an array; empty where there are none."""
    return F.when(first < end, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))


def _at_level(t: int, blocks: Column) -> Column:
    return F.transform(blocks, lambda b: F.struct(F.lit(t).alias("level"), b.alias("block")))


def _cover(start: str, end: str, depth: int) -> Column:
    """The aligned blocks (level, block) that make up positions start .. end - 1, as few as their alignment allows."""
    parts = []
    for t in range(depth + 1):
        width, wider = RADIX**t, RADIX ** (t + 1)
        low, high = F.expr(f"({start} + {width - 1}) div {width}"), F.expr(f"{end} div {width}")
        inner_low, inner_high = F.expr(f"({start} + {wider - 1}) div {wider}"), F.expr(f"{end} div {wider}")
        if t == depth:
            blocks = _run(low, high)
        else:
            # What whole blocks of the next level cover is left to that level.
            edges = F.concat(_run(low, inner_low * RADIX), _run(inner_high * RADIX, high))
            blocks = F.when(inner_low < inner_high, edges).otherwise(_run(low, high))
        parts.append(_at_level(t, blocks))
    return F.concat(*parts)


def range_totals(
    ranges: DataFrame, points: DataFrame, *, low: str, high: str, at: str, value: str, total: str = "total"
) -> DataFrame:
    """Sum of point values inside [low, high] for every range; NULL where no point lies inside.

    The positions are numbered, and sums are kept for aligned blocks of ``RADIX`` positions, of that many blocks, and
    so on.  A range adds the few blocks that make it up, found by equality, so the work does not grow with the number of
    points inside, and no value outside a range touches its sum: doubles lose no digits, and NaN stays where it is.
    """
    summed = points.groupBy(F.col(at).alias("_x")).agg(F.sum(value).alias("_v")).filter("_x IS NOT NULL")
    ends = ranges.select(F.explode(F.array(low, high)).alias("_x")).filter("_x IS NOT NULL").distinct()
    nothing = ends.select("_x", F.lit(None).cast(summed.schema["_v"].dataType).alias("_v"))
    positions = summed.unionByName(nothing).groupBy("_x").agg(F.sum("_v").alias("_v"))
    placed = Stage(global_index(positions, ["_x"], index="_i"), "positions", {"n": F.count("*")})
    depth = 0
    while RADIX**depth < (placed.sums["n"] or 0):
        depth += 1

    blocks = placed.df.select(F.lit(0).alias("_t"), F.col("_i").alias("_b"), "_v")
    if depth:
        # All levels in one pass; neighbours lie in one task, which sums them before the shuffle.
        widths = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(RADIX**t).alias("w")) for t in range(1, depth + 1)]))
        wider = placed.df.select("_i", "_v", widths.alias("_l")).groupBy(F.col("_l.t").alias("_t"), F.expr("_i div _l.w").alias("_b"))
        blocks = blocks.unionByName(wider.agg(F.sum("_v").alias("_v")))
    # Written, so that joins with many ranges on one block or on one pair of ends can be split.
    blocks = written(blocks, "range-blocks")

    spans = (
        ranges.select(F.col(low).alias("_lo"), F.col(high).alias("_hi"))
        .filter("_lo <= _hi")
        .distinct()
        .join(placed.df.select(F.col("_x").alias("_lo"), F.col("_i").alias("_from")), "_lo")
        .join(placed.df.select(F.col("_x").alias("_hi"), (F.col("_i") + 1).alias("_to")), "_hi")
    )
    pieces = spans.select("_lo", "_hi", F.explode(_cover("_from", "_to", depth)).alias("_p")).select(
        "_lo", "_hi", F.col("_p.level").alias("_t"), F.col("_p.block").alias("_b")
    )
    totals = pieces.join(blocks, ["_t", "_b"]).groupBy("_lo", "_hi").agg(F.sum("_v").alias("_total"))
    totals = written(totals, "range-totals")
    same = (F.col(low) == F.col("_lo")) & (F.col(high) == F.col("_hi"))
    return ranges.join(totals, same, "left").select(*ranges.columns, F.col("_total").alias(total))
