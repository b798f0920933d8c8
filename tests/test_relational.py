import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tamarack.functions.text import month_name
from tamarack.operators import relational as rel


def sightings(spark, data):
    return spark.createDataFrame(data, "name string, person string, location string, sighted date")


D = dt.date


def test_keys_meeting_all_needs_one_key_on_both_sides(spark):
    df = sightings(
        spark,
        [
            ("rose", "ann", "mill", None),
            ("rose", "ann", "spring", None),
            ("rose", "bob", "mill", None),
            ("iris", "bob", "spring", None),
            (None, "cid", "mill", None),
            (None, "cid", "spring", None),
        ],
    )
    place = F.col("location")
    met = rel.keys_meeting_all(df, ["person", "name"], [place == "mill", place == "spring"])
    assert rows(met.select("person").distinct()) == [("ann",)]


def test_frequent_groups_skip_null_values_and_bound_is_strict(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "x")], "genus string, species string")
    assert rows(rel.frequent_groups(df, ["genus"], "species", more_than=1)) == [("b", 2)]


def test_argmax_keeps_ties(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 3)], "name string, n int")
    assert rows(rel.argmax_with_ties(df, "n")) == [("b", 3), ("c", 3)]


def test_arg_max_per_group_prefers_smallest_choice(spark):
    df = spark.createDataFrame([("w", 2, 5), ("w", 1, 5), ("v", 3, 1)], "word string, topic int, n int")
    assert rows(rel.arg_max_per_group(df, "word", "topic", "n")) == [("v", 3, 1), ("w", 1, 5)]


def test_never_linked(spark):
    df = sightings(spark, [("a", "p", "t1", None), ("a", "p", "x", None), ("a", "q", "x", None), ("a", "r", "t1", None)])
    towers = spark.createDataFrame([("t1",), ("t2",)], "location string")
    assert rows(rel.never_linked(df, towers, who="person", link="location")) == [("q",)]


def test_count_by_class_zero_duplicate_and_null_class(spark):
    features = spark.createDataFrame(
        [("Spring", "s"), ("Spring", "s"), ("Tower", "t"), (None, "s")], "class string, location string"
    )
    facts = sightings(spark, [("a", "p", "s", None), (None, "p", "s", None), ("b", "q", "s", None)])
    counted = rel.count_by_class(features, facts, by="class", link="location", counted="name")
    assert rows(counted) == [("Spring", 2), ("Tower", 0), (None, 0)]


def test_coverage_ratio_same_month_of_two_years_and_null_date(spark):
    df = sightings(
        spark,
        [("a", "p", "x", D(2006, 8, 1)), ("a", "p", "x", D(2007, 8, 2)), ("b", "p", "x", D(2006, 7, 1)), ("c", "p", "x", None)],
    ).select(month_name(F.col("sighted")).alias("m"), "name")
    assert rows(rel.coverage_ratio(df, by="m", item="name")) == [("August", 1 / 3), ("July", 1 / 3), (None, 0.0)]


def test_divide_all_but_one_and_empty_divisor(spark):
    df = sightings(spark, [("a", "p", "s1", None), ("a", "p", "s2", None), ("a", "q", "s1", None), ("a", "q", "s1", None)])
    summits = spark.createDataFrame([("s1",), ("s2",), ("s2",), (None,)], "location string")
    assert rows(rel.divide(df, summits, who="person", key="location")) == [("p",)]
    nothing = summits.filter("location = 'zzz'")
    assert rows(rel.divide(df, nothing, who="person", key="location")) == []
    assert rows(rel.divide(df, nothing, who="person", key="location", empty_divisor="all")) == [("p",), ("q",)]
    assert rows(rel.divide(df, summits, who="person", key="location", empty_divisor="all")) == [("p",)]


def test_completion_uses_first_dates(spark):
    df = sightings(
        spark,
        [
            ("a", "p", "x", D(2006, 1, 5)),
            ("a", "p", "x", D(2006, 9, 9)),
            ("b", "p", "x", D(2006, 3, 1)),
            ("a", "q", "x", D(2006, 1, 1)),
            (None, "q", "x", D(2006, 1, 1)),
        ],
    )
    assert rows(rel.completion(df, who="person", item="name", when="sighted")) == [("p", D(2006, 3, 1))]


def test_absolute_change_and_semi_anti(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id int, rank double")
    b = spark.createDataFrame([(1, 0.25), (2, 1.0), (3, 9.0)], "id int, rank double")
    assert rel.absolute_change(a, b, key="id", value="rank").first()[0] == 0.75
    assert rows(rel.exists_in(b, a, ["id"]).select("id")) == [(1,), (2,)]
    assert rows(rel.not_exists_in(b, a, ["id"]).select("id")) == [(3,)]


def test_null_concat_is_null(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "g string, s string")
    assert rows(df.select(F.concat("g", F.lit(" "), "s"))) == [("b c",), (None,)]


def test_skewed_join_is_split(spark):
    """A key that holds most rows is split by the adaptive skew join, not sent to one task."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 200_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS link", "uuid() AS filler"
        )
        classes = spark.range(0, 200_000).selectExpr("id AS link", "id % 5 AS class")
        joined = hot.join(classes, "link").groupBy("class").agg(F.count("*").alias("count"), F.max("filler"))
        assert sum(r["count"] for r in joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
