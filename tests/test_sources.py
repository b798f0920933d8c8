import datetime as dt
import glob

from pyspark.sql import functions as F

from conftest import rows
from tamarack.functions.text import contains_flag, path_segment
from tamarack.operators.relational import top_rows
from tamarack.sources import lines as src
from tamarack.sources.generators import coin_flips, planted_outliers, topic_corpus
from tamarack.sources.sinks import format_pair, write_pairs
from tamarack.sources.tables import table


def text(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def record(driver="d1", when="2013-01-07 10:00:00", amount="1.5", extra=()):
    return ",".join(["m", driver, "v", when, "4", "5", "6", "7", "8", "9", amount, *extra])


EDGE = [
    "a,b,c,pickup,e,f,g,h,i,j,total",
    record(),
    record(amount=" 2.5 "),
    record(amount="abc"),
    record(amount=""),
    record(extra=("x",)),
    record(extra=("", "")),
    record(when="2013-13-45 00:00:00"),
    record(when="2013-01-07 10:00:00 junk"),
    record(driver="d=2", when="2013-02-01 00:00:00", amount="4"),
    "1,2,3",
    "",
]


def test_timed_records_drop_what_does_not_parse(spark):
    got = src.timed_records(text(spark, EDGE))
    day = dt.datetime(2013, 1, 7, 10)
    assert rows(got) == sorted(
        [("d1", day, 1.5), ("d1", day, 2.5), ("d1", day, 1.5), ("d=2", dt.datetime(2013, 2, 1), 4.0)], key=repr
    )


def test_keyed_records_do_not_look_at_the_time(spark):
    got = src.keyed_records(text(spark, EDGE)).groupBy("key").agg(F.sum("amount"))
    assert rows(got) == [("d1", 1.5 + 2.5 + 1.5 + 1.5 + 1.5), ("d=2", 4.0)]


def test_dropped_records_add_up(spark):
    got = dict(rows(src.dropped_records(text(spark, EDGE))))
    assert got == {"kept": 4, "field_count": 4, "time": 3, "amount": 1}
    assert sum(got.values()) == len(EDGE)


def test_amount_nan_is_a_number(spark):
    got = src.keyed_records(text(spark, [record(amount="NaN")])).first()
    assert got["amount"] != got["amount"]


def test_pair_records(spark):
    got = src.pair_records(text(spark, ["a\t1.5", "b 2", "c\tx", "d", "e 1 2", "a=b\t3", "f\t4 "]))
    assert rows(got) == [("a", 1.5), ("a=b", 3.0), ("b", 2.0), ("f", 4.0)]


def test_top5_is_deterministic_and_handles_few_keys(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 9.0)], "key string, amount double")
    order = [F.col("amount").desc(), F.col("key")]
    assert [r["key"] for r in top_rows(df, order, 5).collect()] == ["c", "a", "b"]
    assert [r["key"] for r in top_rows(df, order, 2).collect()] == ["c", "a"]


def test_write_pairs_round_trip_sorted_files(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i:03}", i / 2) for i in range(100)], "key string, amount double")
    path = str(tmp_path / "pairs")
    write_pairs(df, path, key="key", value="amount", files=8)
    assert rows(src.pair_records(src.read_lines(spark, path))) == rows(df)
    files = glob.glob(path + "/part-*")
    assert 1 < len(files) <= 8
    for f in files:
        keys = [line.split("\t")[0] for line in open(f)]
        assert keys == sorted(keys)


def test_format_pair(spark):
    df = spark.createDataFrame([("a", "b")], "w1 string, w2 string")
    assert df.select(format_pair("w1", "w2")).first()[0] == "(a, b)"


def test_tagged_documents(spark):
    got = src.tagged_documents(
        text(
            spark,
            [
                '<doc id="20/AU/7" url="u" title="t">some "> text</doc>',
                "no marker here",
                "an id without the attribute",
                '<doc id="20/x/8" url="u">',
            ],
        )
    )
    assert rows(got) == [("20/AU/7", 'some "> text</doc>'), ("20/x/8", "")]
    labelled = got.select(path_segment(F.col("doc_id"), 1), contains_flag(F.col("doc_id"), "AU"))
    assert rows(labelled) == [("AU", 1), ("x", 0)]


def test_labelled_rows_and_numbered_lines(spark, tmp_path):
    path = tmp_path / "bc.txt"
    path.write_text("".join(f"{i},{'M' if i % 2 else 'B'},{i}.5,2\n" for i in range(500)))
    numbered = src.read_numbered_lines(spark, str(path))
    got = src.labelled_rows(numbered, n_features=2).orderBy("row_id").collect()
    assert [r["row_id"] for r in got] == list(range(500))
    assert [r["item"] for r in got] == [str(i) for i in range(500)]
    assert [r["label"] for r in got[:3]] == [-1, 1, -1]
    assert got[3]["features"] == [3.5, 2.0]


def test_labelled_rows_of_odd_lines(spark):
    lines = ["a,M,1,2", "b,B,1", "c,B,1,2,3", "d,M,x,2", "e,B,, 2", "f,B, 1.5 ,NaN", "", None, "g,M,1,2,"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {r["item"]: (r["label"], r["features"]) for r in src.labelled_rows(df, n_features=2).collect()}
    assert got["a"] == (1, [1.0, 2.0]) and sorted(got) == ["a", "f"]
    assert got["f"][0] == -1 and got["f"][1][0] == 1.5 and got["f"][1][1] != got["f"][1][1]
    assert rows(src.dropped_labelled(df, n_features=2)) == [("field_count", 5), ("kept", 2), ("number", 2)]
    assert src.labelled_rows(df.limit(0), n_features=2).collect() == []


def test_generators_are_seeded(spark):
    cloud = planted_outliers(spark, seed=1)
    assert cloud.count() == 3190 and cloud.select("id").distinct().count() == 3190
    assert cloud.filter("id = 7").first() == planted_outliers(spark, seed=1).repartition(3).filter("id = 7").first()
    assert cloud.filter("id = 7").first() != planted_outliers(spark, seed=2).filter("id = 7").first()
    flips = coin_flips(spark, seed=1)
    assert flips.filter("k BETWEEN 0 AND n AND n = 10").count() == 100
    corpus = topic_corpus(spark, docs=5, topics=10, words=50, length=200, seed=1)
    assert corpus.agg(F.sum("n")).first()[0] == 1000


def test_table_scan_prunes_and_pushes(spark):
    df = table(spark, "/root/testdata/sf0.001", "lineitem").filter("l_quantity > 30").select("l_suppkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,30.0)]" in plan
    assert "l_tax" not in plan
