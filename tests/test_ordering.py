import random

from pyspark.sql import functions as F

from conftest import rows
from tamarack.operators.ordering import global_index, range_totals, running_totals, sliding_windows
from tamarack.operators.relational import argmax_with_ties


def test_global_index_is_dense_and_ordered(spark):
    values = random.Random(1).sample(range(10_000), 700)
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(7)
    got = {r["x"]: r["i"] for r in global_index(df, ["x"], index="i").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(300)], "x long, v long")
    got = rows(running_totals(df, ["x"], {"t": "v"}).select("x", "t"))
    total, expected = 0, []
    for i in range(300):
        total += i % 5
        expected.append((i, total))
    assert got == sorted(expected, key=repr)


def windows(values, width):
    ordered = sorted(values, reverse=True)
    return sorted(
        (ordered[i][0], ordered[i + width - 1][0], sum(n for _, n in ordered[i : i + width]))
        for i in range(len(ordered) - width + 1)
    )


def test_sliding_windows_across_bucket_borders(spark):
    rng = random.Random(2)
    values = [(float(k), rng.randrange(9)) for k in rng.sample(range(1000), 137)]
    df = spark.createDataFrame(values, "lat double, n long")
    for bucket in (20, 33, 1000):
        got = sliding_windows(df, key="lat", value="n", width=20, bucket=bucket)
        assert sorted(tuple(r) for r in got.collect()) == windows(values, 20)


def test_sliding_windows_too_few_and_exactly_enough(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(20)], "lat double, n long")
    assert rows(sliding_windows(df, key="lat", value="n", width=20)) == [(19.0, 0.0, 20)]
    assert rows(sliding_windows(df.filter("lat > 0"), key="lat", value="n", width=20)) == []
    assert rows(argmax_with_ties(sliding_windows(df, key="lat", value="n", width=19), "total")) == [
        (18.0, 0.0, 19),
        (19.0, 1.0, 19),
    ]


def test_range_totals_against_brute_force(spark):
    rng = random.Random(3)
    points = [(rng.randrange(60), rng.randrange(10)) for _ in range(200)]
    ranges = [(i, *sorted((rng.randrange(70), rng.randrange(70)))) for i in range(50)]
    ranges += [(50, 10, 5), (51, 100, 200), (52, None, 5)]
    got = range_totals(
        spark.createDataFrame(ranges, "id long, lo long, hi long"),
        spark.createDataFrame(points, "x long, v long"),
        low="lo", high="hi", at="x", value="v",
    )
    expected = {}
    for i, lo, hi in ranges:
        inside = [v for x, v in points if lo is not None and lo <= x <= hi]
        expected[i] = sum(inside) if inside else None
    assert {r["id"]: r["total"] for r in got.collect()} == expected


def test_range_totals_of_doubles_keep_their_digits(spark):
    ranges = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 2, 3), (4, 2, 3)], "id long, lo long, hi long")
    for first in (1e17, float("nan"), float("inf")):
        points = spark.createDataFrame([(1, first), (2, 1.0), (3, 5.0)], "x long, v double")
        got = range_totals(ranges, points, low="lo", high="hi", at="x", value="v")
        assert rows(got.filter("id > 1").select("id", "total")) == [(2, 1.0), (3, 5.0), (4, 6.0), (4, 6.0)]


def test_range_totals_over_several_levels_of_blocks(spark):
    rng = random.Random(5)
    ranges = [(i, *sorted((rng.randrange(5000), rng.randrange(5000)))) for i in range(60)]
    points = spark.range(5000).select(F.col("id").alias("x"), (F.col("id") * F.col("id") % 97).alias("v"))
    got = range_totals(
        spark.createDataFrame(ranges, "id long, lo long, hi long"), points, low="lo", high="hi", at="x", value="v"
    )
    expected = {i: sum(x * x % 97 for x in range(lo, hi + 1)) for i, lo, hi in ranges}
    assert {r["id"]: r["total"] for r in got.collect()} == expected


def test_range_totals_of_nothing(spark):
    ranges = spark.createDataFrame([(1, 1, 2)], "id long, lo long, hi long")
    points = spark.createDataFrame([], "x long, v double")
    assert rows(range_totals(ranges, points, low="lo", high="hi", at="x", value="v")) == [(1, 1, 2, None)]
    assert rows(range_totals(ranges.limit(0), points, low="lo", high="hi", at="x", value="v")) == []


def test_no_single_partition_exchange_of_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = sliding_windows(df, key="k", value="v", width=5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
