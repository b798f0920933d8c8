"""Exact nearest neighbours, distance-based outliers and text classification by neighbours.

A bounded side is handed to every task and the other side is streamed past it where it lies.  When
both are large, dense points are written by the cells of pivots, and each task of a block of queries reads
the points of the cells that the triangle inequality can't exclude; sparse ones are cut into hash blocks, and
a task compares one block of queries with one block of points.  Either way a task keeps only the k nearest
per query; pairs never become rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions import kernels
from tamarack.staging import Stage, broadcast_if_bounded, parallelism

# Bounds on one hash block, and on a side that is handed to every task: rows, and matrix cells.
BLOCK_ROWS = 4_096
HELD_ROWS = 32_768
BLOCK_CELLS = 4_000_000
SMALLEST_BLOCK = 256


def _bounded_rows(most: int, cells_per_row: int) -> int:
    return max(SMALLEST_BLOCK, min(most, BLOCK_CELLS // max(1, cells_per_row)))


def _blocked(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Give each row its own block, and one copy per block of the other side."""
    # Fresh column identities, so that both sides may come from one table.
    fresh = df.select(*[F.col(c).alias(c) for c in df.columns])
    return fresh.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    )


def _merge(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest of the tasks' results; the limit inside the window runs before the shuffle too."""
    nearest_first = Window.partitionBy("query_id").orderBy("distance", "point_id")
    ranked = candidates.withColumn("place", F.row_number().over(nearest_first))
    return ranked.filter(F.col("place") <= k)


def _search(
    queries: DataFrame, points: DataFrame, k: int, *, sizes: tuple[int, int], cells: int, load: Callable, find: Callable
) -> DataFrame:
    """(query_id, point_id, distance, place) by the cheapest of three layouts.

    ``load(table)`` turns Arrow rows into vectors; ``find(qid, q, pid, p)`` compares two sets of them.
    """
    n_queries, n_points = sizes
    if min(n_queries, n_points) > _bounded_rows(HELD_ROWS, cells):
        block = _bounded_rows(BLOCK_ROWS, cells)
        bq, bp = -(-n_queries // block), -(-n_points // block)

        def compare(q: pa.Table, p: pa.Table) -> pa.Table:
            qid = q["id"].to_numpy()
            found = find(qid, load(q), p["id"].to_numpy(), load(p))
            return pa.Table.from_batches([kernels.neighbour_batch(qid, found)])

        left = _blocked(queries, "qb", bq, "pb", bp).groupBy("qb", "pb")
        right = _blocked(points, "pb", bp, "qb", bq).groupBy("qb", "pb")
        return _merge(left.cogroup(right).applyInArrow(compare, kernels.NEIGHBOUR_FIELDS), k)

    if n_points <= n_queries:
        held = points.toArrow()
        pid, p = held["id"].to_numpy(), load(held)

        def stream_queries(batches):
            for batch in batches:
                qid = batch["id"].to_numpy()
                yield kernels.neighbour_batch(qid, find(qid, load(batch), pid, p))

        # A query meets all points in one task, so there is nothing to merge.
        return queries.mapInArrow(stream_queries, kernels.NEIGHBOUR_FIELDS)

    held = queries.toArrow()
    qid, q = held["id"].to_numpy(), load(held)

    def stream_points(batches):
        best = kernels.nothing(len(qid))
        for batch in batches:
            best = kernels.merge(best, find(qid, q, batch["id"].to_numpy(), load(batch)), k)
        yield kernels.neighbour_batch(qid, best)

    return _merge(points.mapInArrow(stream_points, kernels.NEIGHBOUR_FIELDS), k)


ROW_FIELDS = "block int, id long, vector binary"
POINT_FIELDS = "cell int, ids binary, vectors binary"
QUERY_FIELDS = "block int, nth int, ids binary, vectors binary, own binary, bound binary, reached array<int>"
FILE_BLOCKS = 16  # blocks of points that a task writes


class Cells:
    """The cells of a table of points, each of those nearest to one of the pivots.

    Pivots are some of the points, so that they lie where points do, and as many as the points have blocks.  They, and per
    cell the number of its points, its radius and k distances, come to the driver.
    """

    def __init__(self, points: DataFrame, k: int, *, n_points: int, dimensions: int):
        self.k, self.dimensions, self.block = k, dimensions, _bounded_rows(BLOCK_ROWS, dimensions)
        wanted = min(_bounded_rows(HELD_ROWS, dimensions), -(-n_points // self.block))
        chosen = points.orderBy(F.xxhash64("id"), "id").limit(wanted).select("features").toArrow()
        self.pivots = kernels.Pivots(np.unique(kernels.dense(chosen["features"]), axis=0))
        self.n, self.radius, self.first = self._measured(points)

    def _measured(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per cell the number of rows, the largest distance to its pivot, and the k smallest."""
        pivots, n_cells, k = self.pivots, len(self.pivots.at), self.k

        def measure(batches):
            n, radius, first = np.zeros(n_cells, np.int64), np.zeros(n_cells), np.full((n_cells, k), np.inf)
            for batch in batches:
                cell, away = pivots.placed(kernels.dense(batch["features"]))
                cell, away = cell[np.isfinite(away)], away[np.isfinite(away)]
                n += np.bincount(cell, minlength=n_cells)
                np.maximum.at(radius, cell, away)
                held = np.unique(cell)
                every, where = np.concatenate([away, first[held].ravel()]), np.concatenate([cell, np.repeat(held, k)])
                order = np.lexsort((every, where))
                starts = np.searchsorted(where[order], held)
                first[held] = every[order[(starts[:, None] + np.arange(k)).ravel()]].reshape(-1, k)
            held = np.flatnonzero(n)
            columns = [pa.array(held, pa.int32()), pa.array(n[held]), pa.array(radius[held]), pa.array(list(first[held]), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "n", "away", "first"])

        by_task = rows.select("features").mapInArrow(measure, "cell int, n long, away double, first array<double>")
        nearest = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, k)
        found = by_task.groupBy("cell").agg(F.sum("n").alias("n"), F.max("away").alias("away"), nearest.alias("first")).toArrow()
        n, radius, first = np.zeros(n_cells, np.int64), np.zeros(n_cells), np.full((n_cells, k), np.inf)
        if len(found):
            cell = found["cell"].to_numpy()
            n[cell], radius[cell], first[cell] = found["n"].to_numpy(), found["away"].to_numpy(), kernels.dense(found["first"])
        return n, radius, first

    def _in_blocks(self, rows: DataFrame, n: np.ndarray, *, few: bool) -> tuple[DataFrame, np.ndarray]:
        """(block, id, vector) of rows, and the cell of each block; a cell of more than a block's rows has several.

        ``few``: equal rows go to one block, and of those of a batch only as many as can be among anyone's k nearest.
        """
        pieces = np.maximum(1, -(-n // self.block))
        firsts, pivots, k = np.cumsum(pieces) - pieces, self.pivots, self.k

        def assign(batches):
            for batch in batches:
                ids, x = batch["id"].to_numpy(), kernels.dense(batch["features"])
                cell, away = pivots.placed(x)
                if few and len(x):
                    kept = np.flatnonzero(np.isfinite(away))
                    kept = kept[kernels.few_equal(x[kept], ids[kept], k)]
                    ids, x, cell = ids[kept], x[kept], cell[kept]
                if not len(x):
                    continue
                key = (x + 0.0).view(np.uint64) if few else ids.view(np.uint64)[:, None]
                with np.errstate(over="ignore"):
                    odd = np.arange(1, key.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
                    mixed = ((key ^ (key >> np.uint64(29))) * odd).sum(axis=1, dtype=np.uint64) * np.uint64(0xFF51AFD7ED558CCD)
                block = firsts[cell] + ((mixed >> np.uint64(32)) % pieces[cell].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(ids), kernels.pack_rows(x)], names=["block", "id", "vector"])

        return rows.select("id", "features").mapInArrow(assign, ROW_FIELDS), np.repeat(np.arange(len(n)), pieces)

    def points(self, points: DataFrame) -> DataFrame:
        """(cell, ids, vectors), written: the points in blocks.  Of equal points those of the smallest ids stay, as only they
        can be among anyone's k nearest."""
        rows, cells = self._in_blocks(points, self.n, few=True)
        k, dimensions, most = self.k, self.dimensions, self.block

        def pack(batches):
            last, held, ids, vectors = None, 0, [], []

            def packed(block):
                x = np.concatenate(vectors)
                columns = [pa.array([cells[block]], pa.int32()), pa.array([np.concatenate(ids).tobytes()]), pa.array([kernels.pack_matrix(x)])]
                return pa.RecordBatch.from_arrays([columns[0], *(c.cast(pa.binary()) for c in columns[1:])], names=["cell", "ids", "vectors"])

            for batch in batches:
                if not batch.num_rows:
                    continue
                block, own, x = batch["block"].to_numpy(), batch["id"].to_numpy(), kernels.unpack_rows(batch["vector"], dimensions)
                # Equal points follow each other, by id; those of the batch before count too.
                fresh = np.r_[True, (block[1:] != block[:-1]) | (x[1:] != x[:-1]).any(axis=1)]
                start = np.maximum.accumulate(np.where(fresh, np.arange(len(x)), 0))
                place = np.arange(len(x)) - start
                if last is not None and last[0] == block[0] and (last[1] == x[0]).all():
                    place[start == 0] += last[2]
                last = (block[-1], x[-1], place[-1] + 1)
                stays = place < k
                cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    if ids and (block[i] != held or sum(map(len, ids)) >= most):
                        yield packed(held)
                        ids, vectors = [], []
                    held = block[i]
                    if stays[i:j].any():
                        ids.append(own[i:j][stays[i:j]])
                        vectors.append(x[i:j][stays[i:j]])
            if ids:
                yield packed(held)

        tasks = max(min(len(cells), 2 * parallelism(points.sparkSession)), -(-len(cells) // FILE_BLOCKS))
        laid = rows.repartitionById(tasks, F.col("block") % tasks).sortWithinPartitions("block", "vector", "id")
        return Stage(laid.mapInArrow(pack, POINT_FIELDS), "cells").df

    def queries(self, queries: DataFrame, n: np.ndarray) -> DataFrame:
        """(block, nth, ids, vectors, own, bound, reached): the queries in blocks, one to a partition.

        ``own``: the distance to the nearest pivot; ``bound``: one of the k-th neighbour's; ``reached``: the cells that may hold
        one of any row's k nearest.
        """
        rows, cells = self._in_blocks(queries, n, few=False)
        pivots, radius, first, k, dimensions, most = self.pivots, self.radius, self.first, self.k, self.dimensions, self.block

        def pack(batches):
            block, nth, held, ids, vectors = None, 0, 0, [], []

            def packed():
                own_ids, x = np.concatenate(ids), np.concatenate(vectors)
                own, bound, reached = [], [], np.zeros(len(radius), bool)
                for at in range(0, len(x), kernels.CHUNK):
                    d, b = pivots.bounds(x[at : at + kernels.CHUNK], first, k)
                    own.append(d.min(axis=1))
                    bound.append(b)
                    reached |= (kernels.least_away(d, own[-1][:, None], radius) <= b[:, None]).any(axis=0)
                reached = np.flatnonzero(reached & np.isfinite(first[:, 0])).astype(np.int32)
                blobs = [own_ids.tobytes(), kernels.pack_matrix(x), np.concatenate(own).tobytes(), np.concatenate(bound).tobytes()]
                numbers = [pa.array([block], pa.int32()), pa.array([nth], pa.int32())]
                columns = [*numbers, *(pa.array([b], pa.binary()) for b in blobs), pa.array([reached], pa.list_(pa.int32()))]
                return pa.RecordBatch.from_arrays(columns, names=["block", "nth", "ids", "vectors", "own", "bound", "reached"])

            for batch in batches:
                blocks, own, x = batch["block"].to_numpy(), batch["id"].to_numpy(), kernels.unpack_rows(batch["vector"], dimensions)
                cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    for at in range(i, j, most):
                        some = slice(at, min(at + most, j))
                        if ids and (blocks[i] != block or held + some.stop - some.start > most):
                            yield packed()
                            nth, held, ids, vectors = nth + 1, 0, [], []
                        block = blocks[i]
                        ids.append(own[some])
                        vectors.append(x[some])
                        held += some.stop - some.start
            if ids:
                yield packed()

        return rows.repartitionById(len(cells), "block").sortWithinPartitions("block").mapInArrow(pack, QUERY_FIELDS)


def pivot_cells(
    queries: DataFrame, points: DataFrame, k: int, *, n_points: int, dimensions: int, exclude_self: bool = False
) -> tuple[DataFrame, DataFrame]:
    """What a search by cells compares: (id, cell) of the points as written, and of each query with each cell that it reaches."""
    k += exclude_self  # the query itself may be one of those that bound it
    cells = Cells(points, k, n_points=n_points, dimensions=dimensions)
    pivots, radius, first = cells.pivots, cells.radius, cells.first

    def unpack(batches):
        for batch in batches:
            for cell, ids in zip(batch["cell"].to_pylist(), batch["ids"], strict=True):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), cell), pa.int32())], names=["id", "cell"])

    def reach(batches):
        for batch in batches:
            row, cell = pivots.reach(kernels.dense(batch["features"]), radius, first, k)
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(row)), pa.array(cell, pa.int32())], names=["id", "cell"])

    written = cells.points(points).mapInArrow(unpack, "id long, cell int")
    return written, queries.select("id", "features").mapInArrow(reach, "id long, cell int")


def _in_cells(queries: DataFrame, points: DataFrame, k: int, *, n_points: int, dimensions: int, exclude_self: bool) -> DataFrame:
    """``nearest`` by cells.  The task of a block of queries reads all points where they are written, and compares those of the
    cells that its queries reach: no row is copied on disk, however many blocks there are.  A null id is no one's neighbour."""
    alike = queries is points
    points = points.filter("id IS NOT NULL")
    queries = points if alike else queries.filter("id IS NOT NULL")
    cells = Cells(points, k + exclude_self, n_points=n_points, dimensions=dimensions)
    n = cells.n if alike else cells._measured(queries)[0]
    pivots, radius = cells.pivots, cells.radius

    class Asked:
        def __init__(self, ids, vectors, own, bound):
            self.ids, self.own, self.bound = (np.frombuffer(b.as_buffer(), kind).copy() for b, kind in ((ids, np.int64), (own, float), (bound, float)))
            self.x = kernels.unpack_matrix(vectors.as_buffer(), len(self.ids), dimensions)
            self.shifted = self.x - pivots.middle
            self.squares = np.einsum("ij,ij->i", self.shifted, self.shifted)
            self.off = 8 * np.sqrt(1e-15 * dimensions * (self.squares + pivots.squares.max()))
            self.best = np.full((len(self.ids), k), np.inf), np.zeros((len(self.ids), k), np.int64)

        def meet(self, cell, ids, vectors):
            limit = np.minimum(self.bound, self.best[0][:, -1] + self.off)
            d = pivots.to_one(self.shifted, self.squares, cell)
            rows = np.flatnonzero(kernels.least_away(d, self.own, radius[cell]) <= limit)
            if len(rows):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                p = kernels.unpack_matrix(vectors.as_buffer(), len(ids), dimensions)
                centre = pivots.at[cell] + pivots.middle
                kernels.draw_closer(self.best, rows, self.ids, self.x, ids, p, centre, limit[rows], k, exclude_self)

    def search(batches):
        asked = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                key = row["block"].as_py(), row["nth"].as_py()
                if key not in asked:
                    asked[key] = Asked(*(row[c] for c in ("query_ids", "query_vectors", "own", "bound")))
                asked[key].meet(row["cell"].as_py(), row["ids"], row["vectors"])
        for one in asked.values():
            yield kernels.neighbour_batch(one.ids, one.best)

    # All points as one partition, which each task reads anew; on the other side a partition per block of queries.
    blocks = cells.queries(queries, n).withColumnsRenamed({"ids": "query_ids", "vectors": "query_vectors"})
    read = cells.points(points).coalesce(1).hint("shuffle_replicate_nl")
    met = read.join(blocks, F.array_contains("reached", F.col("cell"))).drop("reached")
    return _merge(met.mapInArrow(search, kernels.NEIGHBOUR_FIELDS), k)


def nearest(
    queries: DataFrame, points: DataFrame, k: int, *, exclude_self: bool = False, sizes: tuple[int, int] | None = None
) -> DataFrame:
    """(query_id, point_id, distance, place): the k nearest points, Euclidean, ties by point id.

    Both inputs have (id LONG, features ARRAY<DOUBLE>); a point's id is its own.
    """
    first = points.select(F.size("features")).first()
    sizes = sizes or (queries.count(), points.count())
    if first and min(sizes) > _bounded_rows(HELD_ROWS, first[0]):
        return _in_cells(queries, points, k, n_points=sizes[1], dimensions=first[0], exclude_self=exclude_self)

    def load(table):
        return kernels.dense(table["features"])

    def find(qid, q, pid, p):
        return kernels.dense_closest(qid, q, pid, p, k, exclude_self)

    return _search(
        queries.select("id", "features"),
        points.select("id", "features"),
        k,
        sizes=sizes,
        cells=first[0] if first else 1,
        load=load,
        find=find,
    )


def nearest_sparse(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    *,
    digits: int = 9,
    cells: int = 4_000,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """``nearest`` for packed sparse vectors (id LONG, idx ARRAY<INT>, val ARRAY<DOUBLE>).

    Distances are rounded to ``digits`` so that equal texts tie exactly, then ties go by point id.
    ``cells`` is the number of entries expected in a long vector; it bounds block sizes.  ``sizes``
    are upper bounds of the two row counts, which are counted when they are not given.
    """

    def find(qid, q, pid, p):
        return kernels.sparse_closest(qid, q, pid, p, k, digits)

    return _search(
        queries.select("id", "idx", "val"),
        points.select("id", "idx", "val"),
        k,
        sizes=sizes or (queries.count(), points.count()),
        cells=cells,
        load=kernels.entries,
        find=find,
    )


def kth_distance(queries: DataFrame, points: DataFrame, k: int, *, sizes: tuple[int, int] | None = None) -> DataFrame:
    """(id, score): distance to the k-th nearest other point, or to the farthest if there are fewer."""
    found = nearest(queries, points, k, exclude_self=True, sizes=sizes)
    return found.groupBy(F.col("query_id").alias("id")).agg(F.max("distance").alias("score"))


def _strongest(scores: DataFrame, m: int) -> DataFrame:
    return scores.orderBy(F.col("score").desc(), "id").limit(m)


def knn_outliers(points: DataFrame, *, k: int = 10, m: int = 5) -> DataFrame:
    """(id, score): the m points farthest from their k-th nearest neighbour."""
    n = points.count()
    return _strongest(kth_distance(points, points, k, sizes=(n, n)), m)


def knn_outliers_pruned(
    points: DataFrame,
    *,
    k: int = 10,
    m: int = 5,
    sample: int = 1_024,
    probes: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Same answer as ``knn_outliers`` without scoring every point.

    The k-th distance to a sample bounds a point's score from above.  Points are scored in blocks, those of the largest
    bounds first; the m-th best score so far is the cutoff, which rises from block to block, until no bound reaches it.
    Points that fit into a task are handed to every task, which bounds and scores the queries that it streams past them;
    more are bounded against the sample, and scored in rounds of ``probes * m`` points and then eight times as many.
    """
    n = points.count()
    sample = max(sample, 4 * k)
    first = points.select(F.size("features")).first()
    if first is None:
        return points.select("id", F.lit(0.0).alias("score")).limit(0)
    if n <= _bounded_rows(HELD_ROWS, first[0]):
        return _pruned_in_tasks(points, k, m, sample, block=probes * m, seed=seed)
    return _pruned_in_rounds(points, n, k, m, sample, block=probes * m, seed=seed)


def _pruned_in_tasks(points: DataFrame, k: int, m: int, sample: int, *, block: int, seed: int) -> DataFrame:
    held = points.select("id", "features").toArrow()
    pid, p = held["id"].to_numpy(), kernels.dense(held["features"])
    anchors = np.random.default_rng(seed).permutation(len(pid))[:sample]

    def score(batches):
        best: list[tuple[float, int]] = []
        for batch in batches:
            qid, q = batch["id"].to_numpy(), kernels.dense(batch["features"])
            bounds = kernels.kth(kernels.dense_closest(qid, q, pid[anchors], p[anchors], k, True), short_of=k)
            order = np.argsort(-bounds, kind="stable")
            at, width = 0, block
            while at < len(order):
                here = order[at : at + width]
                # Room for the last digits, in which a bound and a score may differ.
                if len(best) == m and bounds[here[0]] < best[-1][0] - 1e-9 * abs(best[-1][0]):
                    break
                scores = kernels.kth(kernels.dense_closest(qid[here], q[here], pid, p, k, True))
                best += [(float(x), int(i)) for x, i in zip(scores, qid[here], strict=True) if np.isfinite(x)]
                best = sorted(best, key=lambda b: (-b[0], b[1]))[:m]
                at, width = at + width, width * 2
        yield pa.RecordBatch.from_arrays([pa.array([b[1] for b in best], pa.int64()), pa.array([b[0] for b in best], pa.float64())], names=["id", "score"])

    return _strongest(points.select("id", "features").mapInArrow(score, "id long, score double"), m)


def _pruned_in_rounds(points: DataFrame, n: int, k: int, m: int, sample: int, *, block: int, seed: int) -> DataFrame:
    anchors = points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample)
    near_anchors = nearest(points, anchors, k, exclude_self=True, sizes=(n, sample))
    bounds = Stage(
        near_anchors.groupBy(F.col("query_id").alias("id")).agg(
            # With fewer than k anchors near, nothing bounds the score.
            F.when(F.count("*") < k, F.lit(float("inf"))).otherwise(F.max("distance")).alias("bound")
        ),
        "bounds",
    )
    best: list[tuple[float, int]] = []
    left = bounds.df
    while True:
        cutoff = best[-1][0] - 1e-9 * abs(best[-1][0]) if len(best) == m else float("-inf")
        # At most ``block`` ids come to the driver, and no task holds more than HELD_ROWS queries.
        chosen = left.filter(F.col("bound") >= F.lit(cutoff)).orderBy(F.col("bound").desc(), "id").limit(block).collect()
        if not chosen:
            break
        ids = points.sparkSession.createDataFrame([(r["id"],) for r in chosen], "id long")
        probing = points.join(broadcast_if_bounded(ids, block), "id", "left_semi")
        scored = _strongest(kth_distance(probing, points, k, sizes=(block, n)), m).collect()
        best = sorted({*best, *((r["score"], r["id"]) for r in scored)}, key=lambda b: (-b[0], b[1]))[:m]
        last = chosen[-1]
        left = bounds.df.filter((F.col("bound") < F.lit(last["bound"])) | ((F.col("bound") == F.lit(last["bound"])) & (F.col("id") > last["id"])))
        block = min(block * 8, HELD_ROWS)
    bounds.drop()
    return points.sparkSession.createDataFrame([(i, s) for s, i in best], "id long, score double")


def majority_vote(neighbours: DataFrame, *, by: str = "query_id", label: str = "label") -> DataFrame:
    """(by, label): most votes, then the nearest neighbour, then the smallest label."""
    votes = neighbours.groupBy(by, label).agg(F.count("*").alias("_votes"), F.min("distance").alias("_d"))
    best = F.min(F.struct((-F.col("_votes")).alias("v"), F.col("_d"), F.col(label).alias("l"))).alias("_b")
    return votes.groupBy(by).agg(best).select(by, F.col("_b.l").alias(label))
