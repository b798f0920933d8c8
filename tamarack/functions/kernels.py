"""NumPy helpers that run inside Spark tasks, on one batch or block at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

NEIGHBOUR_FIELDS = "query_id long, point_id long, distance double, place int"

# Queries compared at a time, which bounds the size of a dense block.
CHUNK = 512


def dense(column) -> np.ndarray:
    """Matrix of an Arrow list column of equally long lists."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = len(values)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 1))


def entries(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, idx, val) of all entries of packed sparse rows."""
    idx, val = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["idx"], table["val"]))
    sizes = idx.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(idx)), sizes)
    return row, idx.flatten().to_numpy(zero_copy_only=False).astype(np.int64), val.flatten().to_numpy(zero_copy_only=False)


def nothing(n_queries: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((n_queries, 0)), np.zeros((n_queries, 0), np.int64)


def closest(distance: np.ndarray, point: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest per row, ties by point id; an infinite distance marks an empty place."""
    order = np.lexsort((point, distance), axis=1)[:, :k]
    return np.take_along_axis(distance, order, 1), np.take_along_axis(point, order, 1)


def merge(a, b, k: int) -> tuple[np.ndarray, np.ndarray]:
    return closest(np.concatenate([a[0], b[0]], 1), np.concatenate([a[1], b[1]], 1), k)


def dense_closest(qid, q, pid, p, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray]:
    """k nearest rows of ``p`` for each row of ``q``.

    The expanded square preselects a few more than k; their distances are then taken from direct
    differences, which keep their digits when two points almost coincide.
    """
    if not len(qid) or not len(pid):
        return nothing(len(qid))
    p2 = np.einsum("ij,ij->i", p, p)
    width = min(len(pid), k + 8)
    parts = []
    for at in range(0, len(qid), CHUNK):
        qs, ids = q[at : at + CHUNK], qid[at : at + CHUNK]
        rough = p2 - 2.0 * (qs @ p.T)
        if exclude_self:
            rough[ids[:, None] == pid[None, :]] = np.inf
        picked = np.argpartition(rough, width - 1, axis=1)[:, :width]
        picked_rough = np.take_along_axis(rough, picked, 1)
        diff = p[picked] - qs[:, None, :]
        exact = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
        exact[~np.isfinite(picked_rough)] = np.inf
        d, i = closest(exact, pid[picked], k)
        # Where more rows than were picked are equal up to rounding, all of them compete.
        last = picked_rough.max(axis=1)
        limit = last + 1e-9 * (np.abs(last) + p2.max() + 1e-300)
        crowded = np.flatnonzero(np.isfinite(last) & ((rough <= limit[:, None]).sum(axis=1) > width))
        for r in crowded:
            near = np.flatnonzero(rough[r] <= limit[r])
            away = p[near] - qs[r]
            d[r : r + 1], i[r : r + 1] = closest(
                np.sqrt(np.einsum("ij,ij->i", away, away))[None, :], pid[near][None, :], k
            )
        parts.append((d, i))
    return np.concatenate([d for d, _ in parts]), np.concatenate([i for _, i in parts])


def kth(found: tuple[np.ndarray, np.ndarray], *, short_of: int = 0) -> np.ndarray:
    """Distance of the last neighbour found per row, infinite if fewer than ``short_of`` were; nothing found is -inf."""
    distance = found[0]
    n = np.isfinite(distance).sum(axis=1)
    if not distance.shape[1]:
        return np.full(len(distance), np.inf if short_of else -np.inf)
    last = np.take_along_axis(distance, np.maximum(n - 1, 0)[:, None], 1)[:, 0]
    return np.where(n < short_of, np.inf, np.where(n > 0, last, -np.inf))


class Pivots:
    """Distances to a bounded number of points, and what the triangle inequality makes of them."""

    def __init__(self, vectors: np.ndarray):
        # Rounding grows with the size of the numbers, not with their distances, so take their mean off.
        self.middle = vectors.mean(axis=0)
        self.at = vectors - self.middle
        self.squares = np.einsum("ij,ij->i", self.at, self.at)

    def away(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of each row to each pivot, and per row how far they may be off."""
        x = x - self.middle
        squares = np.einsum("ij,ij->i", x, x)
        distance = np.sqrt(np.maximum(squares[:, None] + self.squares - 2.0 * (x @ self.at.T), 0.0))
        return distance, np.sqrt(1e-15 * x.shape[1] * (squares + self.squares.max()))

    def placed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each row, and its distance."""
        nearest, distance = [np.zeros(0, np.int64)], [np.zeros(0)]
        for at in range(0, len(x), CHUNK):
            d, _ = self.away(x[at : at + CHUNK])
            nearest.append(d.argmin(axis=1))
            distance.append(d[np.arange(len(d)), nearest[-1]])
        return np.concatenate(nearest), np.concatenate(distance)

    def to_one(self, x: np.ndarray, squares: np.ndarray, pivot: int) -> np.ndarray:
        """Distances to one pivot of rows ``x`` that have their mean taken off, and their ``squares``."""
        return np.sqrt(np.maximum(squares + self.squares[pivot] - 2.0 * (x @ self.at[pivot]), 0.0))

    def bounds(self, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances of each row to each pivot, and a bound of that to its k-th nearest point, with room for rounding.

        ``first``: per cell the smallest distances of its points to its pivot, ascending, infinite where it has fewer.  A
        point's distance is at most the row's to the pivot and the pivot's to the point, so the k-th smallest such sum
        bounds the k-th neighbour; only the k cells with the smallest sums can hold it.
        """
        d, off = self.away(x)
        some = np.argpartition(d + first[:, 0], min(k, d.shape[1]) - 1, axis=1)[:, :k]
        sums = (np.take_along_axis(d, some, 1)[:, :, None] + first[some]).reshape(len(d), -1)
        bound = np.partition(sums, k - 1, axis=1)[:, k - 1] if sums.shape[1] >= k else np.full(len(d), np.inf)
        return d, bound + 8 * off

    def reach(self, x: np.ndarray, radius: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs: the cells that may hold one of a row's k nearest points.

        ``radius``: per cell the largest distance of a point to its pivot.
        """
        rows, cells = [], []
        for at in range(0, len(x), CHUNK):
            d, bound = self.bounds(x[at : at + CHUNK], first, k)
            row, cell = np.nonzero((least_away(d, d.min(axis=1)[:, None], radius) <= bound[:, None]) & np.isfinite(first[:, 0]))
            rows.append(row + at)
            cells.append(cell)
        return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def least_away(d: np.ndarray, own: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The least distance of a cell's points to rows that are ``d`` from its pivot and ``own`` from the nearest one.

    The points lie within the cell's radius, and no nearer to the row's own pivot than to the cell's.
    """
    return np.maximum(d - radius, (d - own) / 2)


def draw_closer(best, rows, qid, q, pid, p, centre, limit, k: int, exclude_self: bool) -> None:
    """Put those rows of ``p`` into ``best`` that are among the k nearest of the given rows of ``q``; the others keep theirs.

    ``best``: (distance, point) of k places per row, infinite where a place is empty, ascending, ties by point id.  No point
    beyond a row's ``limit`` is needed.  As few are nearer, the expanded square is compared with the limit, and distances
    are taken from direct differences; rows for which many are nearer are searched by ``dense_closest``.
    """
    distance, point = best
    shifted = p - centre
    p2 = np.einsum("ij,ij->i", shifted, shifted)
    for at in range(0, len(rows), CHUNK):
        own = rows[at : at + CHUNK]
        x = q[own] - centre
        q2 = np.einsum("ij,ij->i", x, x)
        rough = x @ shifted.T
        rough *= -2.0
        rough += p2
        most = limit[at : at + CHUNK] ** 2 * (1 + 1e-9) + 1e-9 * (q2 + p2.max()) - q2
        r, c = np.nonzero(rough <= most[:, None])
        if len(r) > 32 * len(own):
            found = dense_closest(qid[own], q[own], pid, p, k, exclude_self)
            distance[own], point[own] = merge((distance[own], point[own]), found, k)
            continue
        if exclude_self:
            other = qid[own[r]] != pid[c]
            r, c = r[other], c[other]
        if not len(r):
            continue
        diff = p[c] - q[own[r]]
        d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        last, last_point = distance[own[r], -1], point[own[r], -1]
        enters = (d < last) | ((d == last) & (pid[c] < last_point))
        if not enters.any():
            continue
        r, c, d = r[enters], c[enters], d[enters]
        changed = np.unique(r)
        row = np.concatenate([np.searchsorted(changed, r), np.repeat(np.arange(len(changed)), k)])
        d, i = np.concatenate([d, distance[own[changed]].ravel()]), np.concatenate([pid[c], point[own[changed]].ravel()])
        order = np.lexsort((i, d, row))
        row = row[order]
        starts = np.searchsorted(row, np.arange(len(changed)))
        kept = order[(starts[:, None] + np.arange(k)).ravel()]
        distance[own[changed]], point[own[changed]] = d[kept].reshape(-1, k), i[kept].reshape(-1, k)


def pack_rows(x: np.ndarray) -> pa.Array:
    """Each row as bytes, of four to a number where that loses nothing; equal rows are equal bytes."""
    x = x + 0.0  # no negative zeros
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    fits = (short == x).all(axis=1)
    if not fits.all():
        return pa.array([(a if f else b).tobytes() for a, b, f in zip(short, x, fits.tolist(), strict=True)], pa.binary())
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (4 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(short.tobytes())])


def unpack_rows(packed: pa.Array, dimensions: int) -> np.ndarray:
    rows = [np.frombuffer(v.as_buffer(), np.float32 if len(v.as_buffer()) == 4 * dimensions else np.float64) for v in packed]
    return np.stack(rows).astype(np.float64) if rows else np.zeros((0, dimensions))


def pack_matrix(x: np.ndarray) -> bytes:
    """Rows one after the other, with four bytes to a number where that loses nothing."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return (short if (short == x).all() else x).tobytes()


def unpack_matrix(packed, rows: int, dimensions: int) -> np.ndarray:
    kind = np.float32 if len(packed) == 4 * rows * dimensions else np.float64
    return np.frombuffer(packed, kind).astype(np.float64).reshape(rows, dimensions)


def few_equal(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which rows stay if of equal ones only those of the k smallest ids do."""
    alike = np.unique(np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, alike))
    first = np.searchsorted(alike[order], alike[order], side="left")
    stays = np.zeros(len(x), bool)
    stays[order] = np.arange(len(x)) - first < k
    return stays


def sparse_closest(qid, q, pid, p, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """k nearest packed sparse rows of ``p`` for each of ``q``; distances rounded to ``digits``."""
    if not len(qid) or not len(pid):
        return nothing(len(qid))
    if len(qid) > CHUNK:
        row, idx, val = q
        parts = []
        for at in range(0, len(qid), CHUNK):
            lo, hi = np.searchsorted(row, [at, at + CHUNK])
            part = (row[lo:hi] - at, idx[lo:hi], val[lo:hi])
            parts.append(sparse_closest(qid[at : at + CHUNK], part, pid, p, k, digits))
        return np.concatenate([d for d, _ in parts]), np.concatenate([i for _, i in parts])
    (q_row, q_idx, q_val), (p_row, p_idx, p_val) = q, p
    # Only dimensions that some query uses matter for the products.
    used = np.unique(q_idx)
    qm = np.zeros((len(qid), len(used)))
    qm[q_row, np.searchsorted(used, q_idx)] = q_val
    q2 = np.bincount(q_row, q_val * q_val, len(qid))
    p2 = np.bincount(p_row, p_val * p_val, len(pid))
    at = np.searchsorted(used, p_idx)
    shared = at < len(used)
    shared[shared] = used[at[shared]] == p_idx[shared]
    p_row, at, p_val = p_row[shared], at[shared], p_val[shared]
    best = nothing(len(qid))
    for start in range(0, len(pid), 256):
        stop = min(start + 256, len(pid))
        lo, hi = np.searchsorted(p_row, [start, stop])
        pm = np.zeros((stop - start, len(used)))
        pm[p_row[lo:hi] - start, at[lo:hi]] = p_val[lo:hi]
        squared = q2[:, None] + p2[None, start:stop] - 2.0 * (qm @ pm.T)
        d = np.round(np.sqrt(np.maximum(squared, 0.0)), digits)
        best = merge(best, (d, np.broadcast_to(pid[start:stop], d.shape)), k)
    return best


def neighbour_batch(qid: np.ndarray, found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Arrow rows of the neighbours found, without the empty places."""
    distance, point = found
    full = np.isfinite(distance)
    query = np.broadcast_to(np.asarray(qid)[:, None], distance.shape)
    place = np.broadcast_to(np.arange(1, distance.shape[1] + 1, dtype=np.int32), distance.shape)
    columns = [query[full].astype(np.int64), point[full].astype(np.int64), distance[full], place[full]]
    names = ["query_id", "point_id", "distance", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
