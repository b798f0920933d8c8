import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tamarack.operators import graph
from tamarack.staging import written


def make(spark, nodes, edges):
    return (
        spark.createDataFrame([(i, f"n{i}") for i in nodes], "id long, title string"),
        spark.createDataFrame(edges, "src long, dst long"),
    )


def union_find(nodes, edges):
    parent = {i: i for i in nodes}
    for a, b in edges:
        parent.setdefault(a, a)
        parent.setdefault(b, b)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in parent}


def labels(df):
    return {r["id"]: r["component"] for r in df.collect()}


def shapes():
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(100, 160)]
    rng.shuffle(path)
    star = [(i, 999) if i % 2 else (999, i) for i in range(200, 240)]
    noise = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    return path + star + noise + [(500, 500), (501, 501), (501, 502), (600, 601), (600, 601), (601, 600)]


def test_components_against_union_find(spark):
    edges = shapes()
    nodes = sorted({x for e in edges for x in e} | {700, 701}) + [702]
    got = labels(graph.connected_components(*make(spark, nodes, edges)))
    assert got == union_find(nodes, edges)


def test_components_do_not_depend_on_partitions_or_direction(spark):
    edges = [(b, a) for a, b in shapes()]
    random.Random(6).shuffle(edges)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            n, e = make(spark, [1], edges)
            assert labels(graph.connected_components(n, e.repartition(5))) == union_find([1], edges)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_edges(spark):
    n, e = make(spark, [3, 4], [(9, 9)])
    assert labels(graph.connected_components(n, e.filter("src < 0"))) == {3: 3, 4: 4}


def chain(start, length):
    return list(range(start, start + length)), [(i + 1, i) for i in range(start, start + length - 1)]


def test_size_band_bounds_and_missing_endpoint(spark):
    nodes, edges = [], []
    for start, length in ((0, 1), (100, 4), (200, 5), (300, 10), (400, 11)):
        n, e = chain(start, length)
        nodes, edges = nodes + n, edges + e
    # Four nodes and one end that is no node: the size is five.
    n, e = chain(500, 4)
    nodes, edges = nodes + n, edges + e + [(503, 999_999)]
    got = graph.components_of_size(*make(spark, nodes, edges)).collect()
    assert sorted(r["id"] for r in got) == [*range(200, 205), *range(300, 310), *range(500, 504)]
    assert {r["size"] for r in got if r["id"] >= 500} == {5}
    assert all(r["title"] == f"n{r['id']}" for r in got)


def test_reachable_is_the_seed_component(spark):
    n, e = make(spark, [1, 2, 3, 4, 5], [(1, 2), (3, 2), (4, 5)])
    seed = spark.createDataFrame([(3,)], "id long")
    assert rows(graph.reachable(n, e, seed)) == [(1,), (2,), (3,)]


def test_degrees_and_never_cited(spark):
    n, e = make(spark, [1, 2, 3], [(1, 2), (1, 2), (1, 3), (2, 3)])
    assert rows(graph.out_degree(n, e)) == [(1, 3), (2, 1), (3, 0)]
    assert rows(graph.never_cited(n, e)) == [(1,)]
    assert rows(graph.undirected(e)) == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]


def ranks_of(nodes, edges, dedupe, tolerance=0.01, damping=0.85):
    links = set(edges)
    degree = {i: sum(1 for a, _ in (links if dedupe else edges) if a == i) for i in nodes}
    n = len(nodes)
    rank = {i: 1.0 / n for i in nodes}
    while True:
        held = sum(r for i, r in rank.items() if degree[i] == 0)
        new = {
            i: (1 - damping) / n
            + damping * (sum(rank[a] / degree[a] for a, b in links if b == i and a in rank) + held / (n - 1))
            for i in nodes
        }
        change = sum(abs(new[i] - rank[i]) for i in nodes)
        rank = new
        if change <= tolerance:
            return rank


def random_graph(n, m, seed):
    rng = random.Random(seed)
    return list(range(n)), [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("dedupe", [True, False])
def test_page_rank_against_plain_python(spark, dedupe):
    nodes, edges = random_graph(40, 90, 7)
    edges = [e for e in edges if e[0] not in (3, 4)] + [(0, 1), (0, 1)] + [(5, i) for i in range(40)]
    expected = ranks_of(nodes, edges, dedupe, tolerance=1e-3)
    # A hub bound below its degree spreads node 5 over several join keys.
    got = graph.page_rank(*make(spark, nodes, edges), dedupe_edges=dedupe, tolerance=1e-3, hub=6)
    for r in got.collect():
        assert abs(r["rank"] - expected[r["id"]]) < 1e-12


def test_page_rank_without_sinks_and_single_node(spark):
    nodes, edges = [0, 1, 2], [(0, 1), (1, 2), (2, 0), (2, 1)]
    expected = ranks_of(nodes, edges, True)
    got = {r["id"]: r["rank"] for r in graph.page_rank(*make(spark, nodes, edges)).collect()}
    assert all(abs(got[i] - expected[i]) < 1e-12 for i in nodes) and abs(sum(got.values()) - 1) < 1e-9
    n, e = make(spark, [7], [(7, 7)])
    assert rows(graph.page_rank(n, e).select("id", "rank")) == [(7, 1.0)]


def test_top_ranked_breaks_ties_by_id(spark):
    nodes = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "id long, title string")
    ranks = spark.createDataFrame([(0, 0.1), (1, 0.4), (2, 0.4), (3, 0.1)], "id long, rank double")
    assert [tuple(r) for r in graph.top_ranked(ranks, nodes, n=3).collect()] == [(1, "n1", 0.4), (2, "n2", 0.4), (0, "n0", 0.1)]


def test_long_path_takes_few_rounds(spark):
    nodes, edges = chain(0, 400)
    got = labels(graph.component_labels(make(spark, nodes, edges)[1], max_rounds=12))
    assert set(got.values()) == {0} and len(got) == 400


def test_rank_mass_stays_near_one(spark):
    nodes, edges = random_graph(30, 40, 8)
    total = graph.page_rank(*make(spark, nodes, edges)).agg({"rank": "sum"}).first()[0]
    assert np.isclose(total, 1.0, atol=0.1)


def test_reachable_from_several_seeds(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 7)], "id long")
    edges = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "src long, dst long")
    seeds = spark.createDataFrame([(1,), (3,)], "id long")
    assert rows(graph.reachable(nodes, edges, seeds)) == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("levels", [0, 1, 3, 16])
def test_reachable_at_every_number_of_levels(spark, levels):
    """A long path, a cycle, a star, loops and repeated edges; seeds on several, one of them on nothing."""
    path = [(i, i + 1) if i % 2 else (i + 1, i) for i in range(100, 112)]
    pairs = path + [(1, 2), (2, 3), (3, 1), (3, 3)] + [(50, i) for i in range(51, 60)] + [(50, 51), (200, 201)]
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 7, 8, 200)], "id long")
    edges = spark.createDataFrame(pairs, "src long, dst long")
    seeds = spark.createDataFrame([(104,), (104,), (2,), (7,), (55,), (999,)], "id long")
    expected = {1, 2, 3, 7, *range(50, 60), *range(100, 113)}
    assert sorted(r.id for r in graph.reachable(nodes, edges, seeds, levels=levels).collect()) == sorted(expected)
    assert rows(graph.reachable(nodes, edges, seeds.limit(0), levels=levels)) == []


def test_reachable_touches_only_the_reached_part(spark, monkeypatch):
    written_rows = []
    stage = graph.Stage
    monkeypatch.setattr(graph, "Stage", lambda df, name, sums=None: written_rows.append((name, df.count())) or stage(df, name, sums))
    nodes = spark.range(0, 3000)
    edges = spark.range(10, 2990).selectExpr("id AS src", "id + 1 AS dst").union(spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long"))
    assert rows(graph.reachable(nodes, edges, nodes.filter("id = 2"))) == [(1,), (2,), (3,)]
    assert [n for name, n in written_rows if name == "level"] == [1, 2, 0]


def test_ranks_that_do_not_settle_are_no_result(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 5)], "id long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2)], "src long, dst long")
    with pytest.raises(RuntimeError):
        graph.page_rank(nodes, edges, max_rounds=1, tolerance=1e-12)


def test_edges_of_a_hub_are_split(spark):
    """The joins of edges with written minima split a centre that holds most edges."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        edges = spark.range(1, 200_000, 1, 8).selectExpr(
            "1000000 + pmod(xxhash64(id), 1000000000000) AS u", "CASE WHEN id % 3 = 0 THEN id - 1 ELSE 0 END AS v"
        )
        least = written(graph._least_around(edges), "least")
        hung = graph._large_star(edges, least).agg(F.count("*").alias("n"), F.max("u"), F.max("v"))
        assert hung.collect()[0]["n"] == 199_999
        assert "skew=true" in hung._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
