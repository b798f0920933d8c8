import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tamarack.functions import vectors as vec
from tamarack.functions.hashing import sample_uniform
from tamarack.functions.text import char_codes, is_blank, pad_left
from tamarack.operators import sampling
from tamarack.operators.sequences import char_sequences, padded_sequences
from tamarack.sources.lines import classed_lines


def test_sample_exact_size_order_and_independence_of_partitions(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("c"))
    kept = sampling.sample_exact(df, n=50, ids=["id"], seed=1, by="c")
    assert rows(kept.groupBy("c").agg(F.count("*"), F.min("sample_order"), F.max("sample_order"))) == [
        (0, 50, 1, 50), (1, 50, 1, 50), (2, 50, 1, 50),
    ]
    again = sampling.sample_exact(df.repartition(11), n=50, ids=["id"], seed=1, by="c")
    assert rows(kept) == rows(again)
    other = sampling.sample_exact(df, n=50, ids=["id"], seed=2, by="c")
    assert rows(kept.select("id")) != rows(other.select("id"))
    smallest = sorted(df.select(sample_uniform(1, F.col("id")).alias("u"), "id").collect())[:20]
    whole = sampling.sample_exact(df, n=20, ids=["id"], seed=1).orderBy("sample_order")
    assert [r["id"] for r in whole.collect()] == [r["id"] for r in smallest]


def test_sample_exact_takes_all_of_a_small_class(spark):
    df = spark.createDataFrame([(i, "big" if i else "small") for i in range(100)], "id long, c string")
    got = sampling.sample_exact(df, n=30, ids=["id"], seed=5, by="c").groupBy("c").count()
    assert rows(got) == [("big", 30), ("small", 1)]


def test_sample_exact_keeps_a_null_class(spark):
    df = spark.createDataFrame([(i, None if i < 10 else "c") for i in range(50)], "id long, c string")
    assert rows(sampling.sample_exact(df, n=4, ids=["id"], seed=5, by="c").groupBy("c").count()) == [("c", 4), (None, 4)]


def test_poisson_sample_has_the_right_moments(spark):
    df = spark.range(20_000)
    counts = sampling.poisson_sample(df, ids=["id"], fraction=0.3, seed=4).groupBy("id").count()
    total, squares = counts.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
    mean, second = total / 20_000, squares / 20_000
    assert abs(mean - 0.3) < 0.02 and abs(second - (0.3 + 0.09)) < 0.03
    assert sampling.poisson_sample(df, ids=["id"], fraction=2.5, seed=4).count() > 48_000


def test_hold_out_and_prefix_split(spark):
    df = spark.createDataFrame([(c, i) for c in "ab" for i in range(1, 11)], "c string, o long")
    got = rows(sampling.hold_out_last(df, n=3, order="o", by="c").filter("split = 'test'").select("c", "o"))
    assert got == [("a", 10), ("a", 8), ("a", 9), ("b", 10), ("b", 8), ("b", 9)]
    split = sampling.prefix_split(spark.range(10), row_id="id", n=4).groupBy("split").count()
    assert rows(split) == [("test", 6), ("train", 4)]


def test_draw_batch_is_with_replacement_and_sized(spark):
    df = spark.range(10).select((F.col("id") * 7).alias("id"))
    got = sampling.draw_batch(df, size=400, ids=["id"], seed=1)
    assert got.count() == 400 and got.select("draw").distinct().count() == 400
    per_row = dict(rows(got.groupBy("id").count()))
    assert set(per_row) == {i * 7 for i in range(10)} and max(per_row.values()) < 80


def test_shuffle_is_a_permutation(spark):
    got = [r["id"] for r in sampling.shuffled(spark.range(200), ids=["id"], seed=3).collect()]
    assert sorted(got) == list(range(200)) and got != list(range(200))


def test_character_sequences(spark):
    a = spark.createDataFrame([(0, "ab€é"), (1, " \t"), (2, "x")], "n long, line string")
    b = spark.createDataFrame([(0, "longest line"), (1, "")], "n long, line string")
    seq = char_sequences(classed_lines(a, b), ids=["n"], per_class=10, seed=1)
    got = {(r["label"], r["n"]): r["padded"] for r in padded_sequences(seq).collect()}
    assert set(got) == {(0, 0), (0, 2), (1, 0)}
    assert got[0, 0] == [-1] * 9 + [97, 98, 233]
    assert got[1, 0] == [ord(c) for c in "longest line"]
    assert all(len(p) == 12 for p in got.values())


def test_sample_comes_before_blank_lines_are_dropped(spark):
    lines = spark.createDataFrame([(i, "" if i % 2 else "text") for i in range(400)], "n long, line string")
    seq = char_sequences(classed_lines(lines), ids=["n"], per_class=100, seed=1)
    assert 20 < seq.count() < 80


def test_text_functions(spark):
    df = spark.createDataFrame([("",), ("  \n",), (" a",)], "line string")
    assert [r[0] for r in df.select(is_blank(F.col("line"))).collect()] == [True, True, False]
    padded = spark.range(1).select(pad_left(F.array(F.lit(5)), F.lit(3)), char_codes(F.lit("")))
    assert tuple(padded.first()) == ([-1, -1, 5], [])


def test_vector_functions(spark):
    rng = np.random.default_rng(1)
    data = [[float(x) for x in rng.normal(size=6)], [2.0] * 6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v array<double>").orderBy("id")
    v = F.col("v")
    z, s, dot, norm = zip(*df.select(vec.standardise(v), vec.softmax(v), vec.dot(v, v), vec.norm(v)).collect())
    x = np.array(data)
    assert np.allclose(z[0], (x[0] - x[0].mean()) / x[0].std()) and z[1] == [0.0] * 6
    assert np.allclose(s, np.exp(x) / np.exp(x).sum(1, keepdims=True))
    assert np.allclose(dot, (x * x).sum(1)) and np.allclose(norm, np.linalg.norm(x, axis=1))
    first = spark.createDataFrame([([0.5, 0.5],), ([-1.0, 0.0],)], "v array<double>")
    assert [r[0] for r in first.select(vec.first_positive_argmax(v)).collect()] == [0, -1]


def test_poisson_steps_of_a_large_fraction():
    steps = sampling.poisson_steps(800.0)
    median = next(k for k, p in enumerate(steps) if p >= 0.5)
    assert abs(median - 800) <= 1
    assert sampling.poisson_steps(0.0) == []
