"""Rows by rank, tables for look-ups, lines numbered where they lie."""

import random

import pytest

from tamarack.operators import sampling
from tamarack.operators.selection import key_at_rank, keys_at_ranks
from tamarack.sources.keyed import look_up, write_keyed
from tamarack.sources.lines import read_numbered_lines


@pytest.mark.parametrize("span", [10, 5_000, 2**40, 2**62])
def test_keys_at_ranks(spark, span):
    rng = random.Random(span)
    keys = [rng.randrange(-span, span) for _ in range(500)] + [7, 7, 7, -span]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    wanted = [0, 1, 250, 502, 503, 504, 9_999]
    ranks = spark.createDataFrame([(r,) for r in wanted], "rank long")
    got = {r.rank: r.k for r in keys_at_ranks(df, "k", ranks).collect()}
    assert got == {r: sorted(keys)[r] for r in wanted if r < len(keys)}
    assert key_at_rank(df, "k", 3) == sorted(keys)[3] and key_at_rank(df, "k", 504) is None
    assert key_at_rank(df.limit(0), "k", 0) is None


def test_batches_by_rank_and_by_number_are_alike(spark):
    df = spark.createDataFrame([(i * 3, str(i * 3).zfill(6), i) for i in range(300)], "id long, name string, x long")
    by_id = sorted(tuple(r) for r in sampling.draw_batch(df, size=50, ids=["id"], seed=4).collect())
    by_name = sorted(tuple(r) for r in sampling.draw_batch(df, size=50, ids=["name"], seed=4).collect())
    assert by_id == by_name and len(by_id) == 50


def test_split_before_rank(spark):
    df = spark.range(10).repartition(3)
    split = {r.id: r.split for r in sampling.split_before_rank(df, key="id", n=4).collect()}
    assert [i for i in sorted(split) if split[i] == "train"] == [0, 1, 2, 3]
    assert {r.split for r in sampling.split_before_rank(df, key="id", n=10).collect()} == {"train"}


def test_look_up_opens_one_folder(spark, tmp_path):
    rows = [(f"k{i % 50}", i) for i in range(400)]
    path = str(tmp_path / "keyed")
    write_keyed(spark.createDataFrame(rows, "key string, x long"), path, key="key", buckets=8, files=2)
    for key in ("k3", "k49", "none"):
        got = look_up(spark, path, key="key", value=key, buckets=8)
        assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in rows if r[0] == key)
    plan = look_up(spark, path, key="key", value="k3", buckets=8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and "PushedFilters: [IsNotNull(key), EqualTo(key,k3)]" in plan


def test_lines_of_many_files_and_blocks_are_numbered_in_order(spark, tmp_path):
    path, lines = tmp_path / "lines", []
    path.mkdir()
    for f in range(5):
        here = [f"{f}-{i} " + "x" * (i % 50) for i in range(f * 700)]
        (path / f"part-{f}.txt").write_text("".join(line + "\n" for line in here))
        lines += here
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        numbered = read_numbered_lines(spark, str(path))
        assert numbered.rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in numbered.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == list(enumerate(lines))
    assert "Exchange hashpartitioning(file" not in numbered._jdf.queryExecution().executedPlan().toString()
