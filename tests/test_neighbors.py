import numpy as np
import pytest

from conftest import rows
from tamarack.operators import neighbors as nb
from tamarack.sources.generators import planted_outliers


def frame(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(matrix)], "id long, features array<double>")


def brute(q, p, k, exclude_self):
    out = []
    for i, a in enumerate(q):
        d = sorted((float(np.linalg.norm(a - b)), j) for j, b in enumerate(p) if not (exclude_self and i == j))[:k]
        out += [(i, j, place + 1, dist) for place, (dist, j) in enumerate(d)]
    return out


def same(got, expected):
    mine = sorted((r["query_id"], r["place"], r["point_id"], r["distance"]) for r in got.collect())
    theirs = sorted((i, place, j, dist) for i, j, place, dist in expected)
    assert [m[:3] for m in mine] == [t[:3] for t in theirs]
    assert np.allclose([m[3] for m in mine], [t[3] for t in theirs], atol=1e-12)


@pytest.mark.parametrize("layout", ["few points", "few queries", "blocks"])
def test_nearest_in_every_layout(spark, monkeypatch, layout):
    rng = np.random.default_rng(1)
    # Small whole numbers make many exact ties and duplicates.
    p = rng.integers(0, 4, (150, 3)).astype(float)
    q = p if layout != "few queries" else p[:20]
    if layout == "blocks":
        monkeypatch.setattr(nb, "BLOCK_ROWS", 40)
        monkeypatch.setattr(nb, "HELD_ROWS", 40)
        monkeypatch.setattr(nb, "SMALLEST_BLOCK", 40)
    got = nb.nearest(frame(spark, q).repartition(3), frame(spark, p).repartition(5), 4, exclude_self=True)
    same(got, brute(q, p, 4, True))


@pytest.mark.parametrize("exclude_self", [True, False])
def test_cells_find_neighbours_across_borders(spark, monkeypatch, exclude_self):
    """Clusters, a third of all points equal, far queries and fewer points in a cell than neighbours asked for."""
    monkeypatch.setattr(nb, "BLOCK_ROWS", 30)
    monkeypatch.setattr(nb, "HELD_ROWS", 60)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", 30)
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.normal(c, 0.3, (40, 4)) for c in (0.0, 3.0, 7.0)] + [np.full((60, 4), 3.0), rng.uniform(-20, 20, (10, 4))])
    q = p if exclude_self else np.concatenate([p[::2] + 0.01, np.full((3, 4), 500.0), np.full((2, 4), 3.0)])
    got = nb.nearest(frame(spark, q).repartition(3), frame(spark, p).repartition(5), 6, exclude_self=exclude_self)
    same(got, brute(q, p, 6, exclude_self))


def test_queries_go_to_few_cells_and_equal_points_to_few_copies(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_ROWS", 30)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", 30)
    rng = np.random.default_rng(6)
    centres = rng.uniform(-100, 100, (30, 5))
    p = np.concatenate([c + rng.normal(0, 0.5, (60, 5)) for c in centres] + [np.zeros((900, 5))])
    df = frame(spark, p)
    cells, reached = nb.pivot_cells(df, df, 5, n_points=len(p), dimensions=5, exclude_self=True)
    assert cells.count() == 30 * 60 + 6
    per_row = reached.count() / len(p)
    assert cells.select("cell").distinct().count() >= 25 and per_row < 4


def test_nearly_equal_points_keep_their_digits(spark):
    base = np.full((1, 5), 1e6)
    p = np.concatenate([base + i * 1e-6 for i in range(30)])
    scores = nb.kth_distance(frame(spark, p), frame(spark, p), 1)
    expected = [min(np.linalg.norm(a - b) for j, b in enumerate(p) if i != j) for i, a in enumerate(p)]
    assert np.allclose([r["score"] for r in scores.orderBy("id").collect()], expected, rtol=1e-9, atol=0)


def outliers(points, k, m):
    scores = []
    for i, a in enumerate(points):
        d = sorted(float(np.linalg.norm(a - b)) for j, b in enumerate(points) if i != j)[:k]
        if d:
            scores.append((-d[-1], i))
    return [(i, -s) for s, i in sorted(scores)[:m]]


def check(df, expected):
    got = sorted(((r["id"], r["score"]) for r in df.collect()), key=lambda x: (-x[1], x[0]))
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert np.allclose([g[1] for g in got], [e[1] for e in expected])


@pytest.mark.parametrize("seed, held", [(1, 32_768), (2, 32_768), (3, 32_768), (1, 50), (2, 50)])
def test_pruned_equals_full_and_brute_force(spark, seed, held, monkeypatch):
    # Points that don't fit into a task are scored in rounds.
    monkeypatch.setattr(nb, "HELD_ROWS", held)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", min(held, nb.SMALLEST_BLOCK))
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(0, 1, (160, 4)), rng.normal(4, 3, (12, 4)), np.zeros((3, 4)) + 9.0])
    expected = outliers(points, 5, 4)
    df = frame(spark, points)
    check(nb.knn_outliers(df, k=5, m=4), expected)
    check(nb.knn_outliers_pruned(df, k=5, m=4, sample=30, probes=2), expected)


def test_pruned_with_uniform_scores_keeps_every_candidate(spark):
    """Points on a ring have nearly equal scores, so almost nothing can be pruned."""
    angle = np.arange(120) * 2 * np.pi / 120
    points = np.stack([np.round(np.cos(angle), 6), np.round(np.sin(angle), 6)], axis=1)
    df = frame(spark, points)
    full = rows(nb.knn_outliers(df, k=3, m=6))
    assert rows(nb.knn_outliers_pruned(df, k=3, m=6, sample=20)) == full


def test_pruned_scores_few_points(spark, monkeypatch):
    """In the generated cloud the planted outliers have the largest bounds, so the first blocks settle the answer."""
    rng = np.random.default_rng(7)
    points = np.concatenate([rng.normal(0, 1, (2000, 6)), rng.normal(0, 20, (8, 6))])
    scored = []
    found = nb.kth_distance
    monkeypatch.setattr(nb, "HELD_ROWS", 300)
    monkeypatch.setattr(nb, "kth_distance", lambda q, p, k, **o: scored.append(o["sizes"][0]) or found(q, p, k, **o))
    check(nb.knn_outliers_pruned(frame(spark, points), k=5, m=4, sample=200), outliers(points, 5, 4))
    assert sum(scored) <= 300


def test_duplicates_count_at_distance_zero_and_few_points(spark):
    check(nb.knn_outliers(frame(spark, [[0.0], [0.0], [0.0], [5.0]]), k=2, m=2), [(3, 5.0), (0, 0.0)])
    check(nb.knn_outliers(frame(spark, [[0.0], [1.0], [5.0]]), k=10, m=2), [(0, 5.0), (2, 5.0)])
    assert nb.knn_outliers(frame(spark, [[0.0]]), k=3).collect() == []
    # The sample is then all points, and each bound a score.
    check(nb.knn_outliers_pruned(frame(spark, [[0.0], [0.0], [0.0], [5.0]]), k=2, m=2), [(3, 5.0), (0, 0.0)])
    assert nb.knn_outliers_pruned(frame(spark, [[0.0]]), k=3).collect() == []


def test_generated_cloud_finds_planted_outliers(spark):
    cloud = planted_outliers(spark, seed=4)
    full = rows(nb.knn_outliers(cloud))
    assert len(full) == 5 and all(r[0] >= 3000 for r in full)
    assert rows(nb.knn_outliers_pruned(cloud)) == full


def sparse(spark, matrix, first=0):
    data = []
    for i, v in enumerate(matrix):
        at = np.flatnonzero(v)
        data.append((first + i, [int(x) for x in at], [float(v[x]) for x in at]))
    return spark.createDataFrame(data, "id long, idx array<long>, val array<double>")


@pytest.mark.parametrize("block", [4096, 12])
def test_nearest_sparse_keeps_documents_without_shared_words(spark, monkeypatch, block):
    rng = np.random.default_rng(2)
    p = rng.integers(0, 3, (60, 25)) * (rng.random((60, 25)) < 0.2) / 4.0
    q = np.concatenate([rng.integers(0, 3, (15, 25)) * (rng.random((15, 25)) < 0.2) / 4.0, np.zeros((1, 25)), p[:2]])
    monkeypatch.setattr(nb, "BLOCK_ROWS", block)
    monkeypatch.setattr(nb, "HELD_ROWS", block)
    monkeypatch.setattr(nb.kernels, "CHUNK", 7)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", block)
    got = nb.nearest_sparse(sparse(spark, q).repartition(2), sparse(spark, p).repartition(4), 7)
    expected = []
    for i, a in enumerate(q):
        d = sorted((round(float(np.linalg.norm(a - b)), 9), j) for j, b in enumerate(p))[:7]
        expected += [(i, j, place + 1, dist) for place, (dist, j) in enumerate(d)]
    mine = sorted((r["query_id"], r["place"], r["point_id"], r["distance"]) for r in got.collect())
    theirs = sorted((i, place, j, dist) for i, j, place, dist in expected)
    assert [m[:3] for m in mine] == [t[:3] for t in theirs]
    assert np.allclose([m[3] for m in mine], [t[3] for t in theirs], atol=1e-8)


def test_majority_vote_ties(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.3), (1, "b", 0.1), (1, "b", 0.5), (2, "a", 0.3), (2, "b", 0.1), (3, "b", 0.2), (3, "a", 0.2)],
        "query_id long, label string, distance double",
    )
    assert rows(nb.majority_vote(df)) == [(1, "b"), (2, "b"), (3, "a")]


def test_rows_are_not_copied_to_the_blocks_they_meet(spark, monkeypatch):
    """Among random vectors nothing is excluded, and every block of queries meets every block of points."""
    monkeypatch.setattr(nb, "BLOCK_ROWS", 30)
    monkeypatch.setattr(nb, "HELD_ROWS", 60)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", 30)
    stages = []
    write = nb.Stage
    monkeypatch.setattr(nb, "Stage", lambda df, *rest: stages.append(write(df, *rest)) or stages[-1])
    p = np.random.default_rng(9).normal(0, 1, (600, 24))
    df = frame(spark, p)
    found = nb.nearest(df, df, 5, exclude_self=True)
    assert sum(s.df.count() for s in stages) <= len(p)
    # Queries are shuffled to their blocks, and what was found for each to one place.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 0
    same(found, brute(p, p, 5, True))
    reached = nb.pivot_cells(df, df, 5, n_points=len(p), dimensions=24, exclude_self=True)[1]
    assert reached.count() > 10 * len(p)


@pytest.mark.parametrize("exclude_self", [True, False])
def test_cells_hold_any_numbers_and_repeated_ids(spark, monkeypatch, exclude_self):
    """Numbers that need eight bytes beside others, both zeros, many equal points, far from zero and ids that come twice."""
    monkeypatch.setattr(nb, "BLOCK_ROWS", 25)
    monkeypatch.setattr(nb, "HELD_ROWS", 50)
    monkeypatch.setattr(nb, "SMALLEST_BLOCK", 25)
    monkeypatch.setattr(nb.kernels, "CHUNK", 16)
    rng = np.random.default_rng(10)
    short = rng.integers(-4, 5, (60, 3)) / 4.0
    long = 1e6 + rng.normal(0, 1e-3, (50, 3))
    equal = np.array([[0.0, -0.0, 0.0], [-0.0, 0.0, 0.0]] * 30 + [[1e6, 1e6, 0.1]] * 9)
    p = np.concatenate([short, long, equal])[rng.permutation(179)]
    same(nb.nearest(frame(spark, p).repartition(4), frame(spark, p).repartition(3), 4, exclude_self=exclude_self), brute(p, p, 4, exclude_self))
    # Of rows of one id none is the neighbour of another, where a point is none of its own.
    ids = [i // 2 for i in range(len(p))]
    rows_ = [(i, [float(x) for x in v]) for i, v in zip(ids, p)] + [(None, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows_, "id long, features array<double>")
    got = {}
    for r in nb.nearest(df, df, 4, exclude_self=exclude_self).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["point_id"]))
    assert set(got) == set(ids)
    for i, found in got.items():
        away = [(float(np.linalg.norm(p[a] - p[b])), ids[b]) for a in range(len(p)) if ids[a] == i for b in range(len(p)) if not (exclude_self and ids[b] == i)]
        assert np.allclose(sorted(d for d, _ in found), sorted(d for d, _ in away)[:4], atol=1e-12)
