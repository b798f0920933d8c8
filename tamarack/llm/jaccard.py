"""Near-duplicate documents: an exact Jaccard join of word shingles, size-aware, with heavy and light parts.

A document's set is its distinct five-word shingles, as 64-bit hashes; two sets link from a Jaccard similarity of 0.75.
Documents with the same words are one *node*, named by a hash of the words, so copies cost nothing.

* Small sets enumerate the two-element subsets of their prefix: by a global order of shingles, two linked sets share at
  least two of their first |s| - ceil(0.75 |s|) + 2 elements, so they share a subset.
* Large sets are found by scanning the inverted lists of single prefix elements, |s| - ceil(0.75 |s|) + 1 of them.
* The size that parts small from large is the one of least estimated cost: subsets written against list entries scanned.
  Sets just below it write both, so that a small and a large set meet.
* The global order puts frequent shingles last (of the corpus as it is, counted over all documents, up to ``MOST_HEAVY``),
  so lists are short; a passage that many documents share hardly occurs in prefixes.

Lists of up to ``SHORT`` nodes give their pairs.  A longer one (thousands of near copies) is first compared with one
node per size band only, then those outside the list's largest component with a few more nodes of it.  Members of that
component need no comparison among themselves.  Every member that is still outside could link with any of the list: for
those lists, what each member shares with one pivot of the list is counted by parts of the universe of shingles, once per
member.  Two members share no more than the smaller of their counts, part by part, and only pairs that could link by that
are compared.  So no link between components is lost, and a group of m near copies costs about m comparisons.

A pair found is first held against its sets' outlines: bitmaps of two to four bits per element, each bit the parity of the
elements that fall on it (an odd sketch).  Two outlines differ in at most as many bits as the sets in elements, so no link
is lost, and few pairs beside the links are left.  Those are checked on the whole sets.

Shuffles carry packed arrays of keys and nodes, one per task batch and bucket.  A key's list beyond ``PIECE`` entries
is dealt over several buckets, and the joins on long lists have a written side, which the adaptive join may split.

Defined cases: null and empty texts, and those of white space only, have an empty set and link with nothing; rows with
a null id take part, and a component's id is its smallest id that isn't null; repeated rows are copies; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tamarack.llm.common import shuffle_parts, texts
from tamarack.llm.exact import without
from tamarack.operators.graph import component_labels
from tamarack.staging import Stage

WIDTH = 5
SHORT = 24  # nodes of a list whose pairs are all taken at once
HEAVY = 8  # documents from which a cell of shingles can count as frequent
MOST_HEAVY = 8_000_000  # frequent cells known to all tasks: 8 bytes each
MARK_BITS = 22  # at least; up to 8 times as many marks as there are frequent cells
CELL_SHIFT = 35  # a cell of the counts is what is left of a shingle's 64 bits
PIECE = 5_000  # entries of a list per bucket
PARTS = 16  # of the universe, by which what a member shares with a pivot is counted
ROUNDS = 2  # further nodes that those outside a list's largest component are compared with, before all
BUCKET_BYTES = 32 << 20
BOUNDARIES = (0, 4, 8, 16, 32)  # sizes that may part small sets from large ones
ROWS = 512
PACKED = 2_048  # documents whose shingles or keys are held at a time
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SCRAMBLE = np.uint64(0xFF51AFD7ED558CCD)
_FIRST = np.ones(1, dtype=bool)


def needed(n: np.ndarray | int) -> np.ndarray | int:
    """The least overlap that a set of n elements has with any set it links with: ceil(0.75 n)."""
    return (3 * n + 3) // 4


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """Turns texts into sets; remembers the hashes of words."""

    def __init__(self) -> None:
        self.known = _WordHashes()

    def words(self, text: str) -> list[bytes]:
        # For bytes, lower() changes A-Z only and split() knows exactly the six white space characters.
        return text.encode("utf-8", "surrogatepass").lower().split()

    def node(self, words: list[bytes], seed: int) -> tuple[int, str]:
        """The 64-bit name of a word sequence, and 128 further bits to tell colliding names apart."""
        digest = hashlib.blake2b(b" ".join(words), digest_size=24, salt=seed.to_bytes(8, "little")).digest()
        return int.from_bytes(digest[:8], "little", signed=True), digest[8:].hex()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The set, ascending."""
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > 1 << 18:
            known.clear()
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(WIDTH, len(words))
        total = np.full(len(h) - width + 1, width, dtype=np.uint64)
        # Products of arrays wrap around.
        for k in range(width):
            total *= _MULTIPLIER
            total += h[k : len(h) - width + 1 + k]
            total ^= total >> np.uint64(29)
        total ^= total >> np.uint64(32)
        total *= _SCRAMBLE
        total ^= total >> np.uint64(31)
        total.sort()
        return total[np.concatenate([_FIRST, total[1:] != total[:-1]])]


class Frequent:
    """The counts of frequent cells, which are ascending."""

    def __init__(self, heavy: np.ndarray, counts: np.ndarray):
        self.heavy, self.counts = heavy, counts
        # By a cell's lower bits, whether any frequent one has them: most cells need no search.
        bits = max(MARK_BITS, (4 * len(heavy)).bit_length())
        self.lower = np.uint32((1 << bits) - 1)
        self.marks = np.zeros(1 << bits, dtype=bool)
        self.marks[heavy & self.lower] = True

    def how_often(self, items: np.ndarray) -> np.ndarray:
        """The counts of shingles in frequent cells, 0 for others."""
        often = np.zeros(len(items), dtype=np.int64)
        cells = (items >> np.uint64(CELL_SHIFT)).astype(np.uint32)
        maybe = np.flatnonzero(self.marks[cells & self.lower])
        if len(maybe):
            cells = cells[maybe]
            at = np.searchsorted(self.heavy, cells)
            at[at == len(self.heavy)] = 0
            often[maybe] = np.where(self.heavy[at] == cells, self.counts[at], 0)
        return often


def outline(items: np.ndarray) -> bytes:
    """A set's odd sketch, of the least power of two of bits that holds two per element, 64 at least."""
    bits = max(64, 1 << (2 * len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def outlines_differ(x: bytes, y: bytes) -> int:
    """A lower bound of how many elements are in one set only."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        # The halves of an outline fold into the outline of half as many bits.
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def prefix(items: np.ndarray, length: int, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first elements of a set by the global order, and their counts: those that aren't frequent by value, then the
    others by (count, value)."""
    light = items[often == 0]
    if len(light) >= length:
        return light[:length], np.zeros(length, dtype=np.int64)
    rest, their = items[often > 0], often[often > 0]
    order = np.lexsort((rest, their))[: length - len(light)]
    return np.concatenate([light, rest[order]]), np.concatenate([np.zeros(len(light), dtype=np.int64), their[order]])


def subset_keys(first: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each two-element subset, and the smaller count of the two: as many documents at most hold both."""
    order = np.argsort(first)
    ordered, often = first[order], often[order]
    i, j = np.triu_indices(len(ordered), 1)
    with np.errstate(over="ignore"):
        key = (ordered[i] * _MULTIPLIER ^ (ordered[j] >> np.uint64(7))) + ordered[j] * _SCRAMBLE
    return key ^ (key >> np.uint64(31)), np.minimum(often[i], often[j])


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            yield whole.slice(start, rows)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _slices(batches, ROWS)


def members(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, node, proof, n, outline) of every document; a task gives a node's outline once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        for batch in _strings(batches):
            nodes, proofs, sizes, outlines = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = shingler.words(text)
                node, proof = shingler.node(words, seed)
                nodes.append(node)
                proofs.append(proof)
                items = shingler.hashes(words)
                sizes.append(len(items))
                outlines.append(None if node in seen or not words else outline(items))
                seen.add(node)
            columns = [
                batch.column(0),
                pa.array(nodes, pa.int64()),
                pa.array(proofs, pa.string()),
                pa.array(sizes, pa.int32()),
                pa.array(outlines, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "proof", "n", "outline"])

    return docs.mapInArrow(run, "doc_id long, node long, proof string, n int, outline binary")


def _steps(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as their differences, all first bytes first: the shuffle's compression does the rest."""
    return np.diff(ascending, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_steps(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _cell_counts(docs: DataFrame, seed: int, shingles: float) -> DataFrame:
    """(cell, m, c0..): documents per cell of shingles, in all and by size above a boundary; cells of ``HEAVY`` or more.

    A cell is a shingle's first 29 bits; packed with the kind of size in 32 bits, all shingles of all documents are
    counted.  Cells may hold several shingles: for an order by frequency that is near enough.
    """
    buckets = max(shuffle_parts(docs.sparkSession), int(shingles * 4 / BUCKET_BYTES) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        for whole in _slices(batches, PACKED):
            cells = [np.zeros(0, dtype=np.uint32)]
            for batch in _strings(iter([whole])):
                for text in batch.column(1).to_pylist():
                    words = shingler.words(text)
                    node, _ = shingler.node(words, seed)
                    if node in seen or not words:
                        continue
                    seen.add(node)
                    items = shingler.hashes(words)
                    kind = np.uint32(sum(len(items) > b for b in BOUNDARIES))
                    cells.append((items >> np.uint64(CELL_SHIFT)).astype(np.uint32) << np.uint32(3) | kind)
            flat = np.sort(np.concatenate(cells))
            if not len(flat):
                continue
            bucket = (flat.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            held = np.unique(bucket)
            ends = np.searchsorted(bucket, held, side="right")
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            blobs = [_steps(flat[x:y]) for x, y in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "cells"])

    names = ["cell", "m", *(f"c{i}" for i in range(len(BOUNDARIES)))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's buckets are ranges of cells, the kinds of a cell next to each other but for a bucket's ends.
        parts = [_from_steps(x.as_py()) for batch in batches for x in batch.column(1)]
        if parts:
            flat = np.concatenate(parts)
            parts.clear()
            flat.sort()
            cell = flat >> np.uint32(3)
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            m = np.diff(np.append(starts, len(flat)))
            often = m >= HEAVY
            cell, m, kind = cell[starts[often]].astype(np.int64), m[often], flat[np.repeat(often, m)] & np.uint32(7)
            firsts = np.cumsum(m) - m  # of the frequent cells' entries
            above = [np.add.reduceat((kind > i).astype(np.int64), firsts) if len(m) else m for i in range(len(BOUNDARIES))]
            columns = [cell, m, *above]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    packed = docs.mapInArrow(pack, "bucket int, cells binary")
    return packed.repartitionById(buckets, "bucket").mapInArrow(count, ", ".join(f"{n} long" for n in names))


def frequent_cells(often: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The cells of (cell, m), ascending, and their counts; of more than ``MOST_HEAVY`` those of the largest counts.

    They grow with the corpus: a shingle that they lack counts as rare, and the sets that hold it are compared with each
    other, however many they are.
    """
    # As many rows as there are different counts.
    known = sorted((r["m"], r["count"]) for r in often.groupBy("m").count().collect())
    room = MOST_HEAVY
    while known and known[-1][1] <= room:
        room -= known.pop()[1]
    # Of the cells with the largest count that doesn't fit, the share for which there is room.
    least, cut = (known[-1][0], room * (1 << (64 - CELL_SHIFT)) // known[-1][1]) if known else (0, 0)
    taken = often.filter((F.col("m") > least) | ((F.col("m") == least) & (F.col("cell") < cut)))
    rows = taken.select(F.col("cell").cast("int"), F.least("m", F.lit((1 << 31) - 1)).cast("int").alias("m")).toArrow()
    cells, counts = rows["cell"].to_numpy().astype(np.uint32), rows["m"].to_numpy().astype(np.uint32)
    order = np.argsort(cells)
    return cells[order], counts[order]


def boundary(sizes: dict[int, int], entries: float, scans: list[float]) -> int:
    """The boundary of least cost: subsets and list entries written, and pairs met in lists.

    ``sizes``: documents by size up to the largest boundary's 4/3; ``entries``: prefix elements of all documents;
    ``scans``: pairs met in the lists of single elements by sets above each boundary.
    """
    best, chosen = None, 0
    for limit, scanned in zip(BOUNDARIES, scans, strict=True):
        subsets = sum(d * (p * (p - 1) // 2) for n, d in sizes.items() if 1 < n <= limit for p in [n - needed(n) + 2])
        singles = entries - sum(d * (n - needed(n) + 1) for n, d in sizes.items() if 0 < n < 0.75 * (limit + 1))
        cost = subsets + singles + scanned
        if best is None or cost < best:
            best, chosen = cost, limit
    return chosen


def candidates(docs: DataFrame, seed: int, heavy: np.ndarray, counts: np.ndarray, limit: int, entries: float) -> DataFrame:
    """(kind, key, a, b): kind 0 a pair of nodes a < b; kind 1 an entry of a long list, node a, whose elements b counts:
    all of them in its lower 32 bits, the infrequent ones above (0 in the list of an infrequent key)."""
    spark = docs.sparkSession
    buckets = max(shuffle_parts(spark), int(entries * 24 / BUCKET_BYTES) + 1)
    sent = spark.sparkContext.broadcast((heavy, counts))  # MOST_HEAVY numbers each, or some more

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        frequent = Frequent(*sent.value)
        for whole in _slices(batches, PACKED):
            keys, nodes, sizes, counted = [], [], [], []
            for batch in _strings(iter([whole])):
                for text in batch.column(1).to_pylist():
                    words = shingler.words(text)
                    node, _ = shingler.node(words, seed)
                    if node in seen or not words:
                        continue
                    seen.add(node)
                    items = shingler.hashes(words)
                    n = len(items)
                    small = 1 < n <= limit
                    often_here = frequent.how_often(items)
                    # For lists of frequent elements, beside its size, how many infrequent elements a set has.
                    described = n | int((often_here == 0).sum()) << 32
                    own = []
                    if small:
                        own.append(subset_keys(*prefix(items, n - needed(n) + 2, often_here)))
                    if not small or n >= 0.75 * (limit + 1):
                        own.append(prefix(items, n - needed(n) + 1, often_here))
                    for k, o in own:
                        keys.append(k)
                        counted.append(o)
                        nodes.append(np.full(len(k), node, dtype=np.int64))
                        sizes.append(np.where(o > 0, described, n))
            if not keys:
                continue
            key, node, size, often = (np.concatenate(x) for x in (keys, nodes, sizes, counted))
            # A long list's entries go to several buckets; a negative size tells that they do.
            pieces = -(-often // PIECE)
            size = np.where(pieces > 1, -size, size)
            shift = np.where(pieces > 1, node.view(np.uint64) % np.maximum(pieces, 1).astype(np.uint64), 0).astype(np.uint64)
            with np.errstate(over="ignore"):
                mixed = (key + shift * _SCRAMBLE) * _MULTIPLIER
            bucket = ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = np.split(order, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[g[0]]) for g in groups], pa.int32()),
                    pa.array([key[g].tobytes() for g in groups], pa.binary()),
                    pa.array([node[g].tobytes() for g in groups], pa.binary()),
                    pa.array([size[g].tobytes() for g in groups], pa.binary()),
                ],
                names=["bucket", "keys", "nodes", "sizes"],
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        current = None

        def lists(bucket_parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            key = np.concatenate([np.frombuffer(p[0], np.uint64) for p in bucket_parts])
            node = np.concatenate([np.frombuffer(p[1], np.int64) for p in bucket_parts])
            size = np.concatenate([np.frombuffer(p[2], np.int64) for p in bucket_parts])
            order = np.lexsort((node, key))
            key, node, size = key[order], node[order], size[order]
            # Copies from different tasks fall together.
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            key, node, size = key[fresh], node[fresh], size[fresh]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
            lengths = np.diff(np.append(starts, len(key)))
            long = (lengths > SHORT) | (size[starts] < 0)
            described = np.abs(size)
            size = described & 0xFFFFFFFF
            rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[long], lengths[long], strict=True)]) if long.any() else []
            rows = np.asarray(rows, dtype=np.int64)
            if len(rows):
                yield _rows(1, key[rows].view(np.int64), node[rows], described[rows])
            for n in range(2, SHORT + 1):
                of_length = starts[(lengths == n) & ~long]
                for i in range(n - 1):
                    # Each list's pairs at the same two places, for all lists of the length.
                    left = np.repeat(of_length + i, n - 1 - i)
                    right = (of_length[:, None] + np.arange(i + 1, n)).ravel()
                    fits = 4 * np.minimum(size[left], size[right]) >= 3 * np.maximum(size[left], size[right])
                    if fits.any():
                        yield _rows(0, np.zeros(int(fits.sum()), dtype=np.int64), node[left[fits]], node[right[fits]])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "keys", "nodes", "sizes")]
            for b, k, n, s in zip(*columns, strict=True):
                if current is not None and b != current:
                    yield from lists(parts.pop(current))
                current = b
                parts.setdefault(b, []).append((k, n, s))
        if current is not None:
            yield from lists(parts.pop(current))

    packed = docs.mapInArrow(pack, "bucket int, keys binary, nodes binary, sizes binary")
    laid = packed.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    return laid.mapInArrow(scan, "kind byte, key long, a long, b long")


def _rows(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, dtype=np.int8)), pa.array(key), pa.array(a), pa.array(b)], names=["kind", "key", "a", "b"]
    )


def sets_of(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """(node, items) of the documents with the wanted ids; ``items`` are the packed hashes, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _strings(batches):
            nodes, items = [], []
            for text in batch.column(1).to_pylist():
                words = shingler.words(text)
                nodes.append(shingler.node(words, seed)[0])
                items.append(shingler.hashes(words).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(items, pa.binary())], names=["node", "items"])

    same = F.col("doc_id").eqNullSafe(F.col("wanted"))
    return docs.join(wanted, same, "left_semi").mapInArrow(run, "node long, items binary")


def close(pairs: DataFrame, outlines: DataFrame) -> DataFrame:
    """The pairs (a, b) that may link by their outlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, first, second = (batch.column(i).to_pylist() for i in range(2, 6))
            # With d elements in one set only, similarity 0.75 means 7 d <= n_a + n_b.
            keep = [7 * outlines_differ(x, y) <= n + m for n, m, x, y in zip(n_a, n_b, first, second, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = outlines.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("outline").alias("first"))
    second = outlines.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("outline").alias("second"))
    sizes_fit = 4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
    both = pairs.join(first, "a").join(second, "b").filter(sizes_fit)
    return both.select("a", "b", "n_a", "n_b", "first", "second").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, checked on all their elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(batch.schema.get_field_index(c)) for c in ("items_a", "items_b"))
            keep = []
            for x, y in zip(left, right, strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                if not len(a) or 4 * len(a) < 3 * len(b):
                    keep.append(False)
                    continue
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                shared = int((b[at] == a).sum())
                keep.append(100 * shared >= 75 * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    second = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "items_a", "items_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def overlaps(pairs: DataFrame, sets: DataFrame, heavy: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(node, pivot, shared, often) of pairs (node, pivot): the numbers of elements that their sets share, and of frequent
    ones among them, by ``PARTS`` parts of the universe."""
    sent = pairs.sparkSession.sparkContext.broadcast((heavy, counts))  # MOST_HEAVY numbers each, or some more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(*sent.value)
        for batch in batches:
            shared, often = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both = np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True)
                part = (both % np.uint64(PARTS)).astype(np.int64)
                shared.append(np.bincount(part, minlength=PARTS))
                often.append(np.bincount(part, frequent.how_often(both) > 0, PARTS).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64()))],
                names=["node", "pivot", "shared", "often"],
            )

    own = sets.select("node", F.col("items").alias("items_a"))
    other = sets.select(F.col("node").alias("pivot"), F.col("items").alias("items_b"))
    both = pairs.join(own, "node").join(other, "pivot").select("node", "pivot", "items_a", "items_b")
    return both.mapInArrow(run, "node long, pivot long, shared array<long>, often array<long>")


def _ends(pairs: DataFrame) -> DataFrame:
    """(node) of both ends of pairs."""
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _labels(links: DataFrame) -> DataFrame:
    return component_labels(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _may_link(n: str, rare: str, other_n: str, other_rare: str) -> Column:
    """Whether two members of a long list can link, if they have shared no infrequent element.

    A set is in a frequent element's list only if all its infrequent elements are in its prefix as well, so two sets
    that share one of those meet in that element's list.  All others share frequent elements at most.
    """
    most = F.least(F.col(n) - F.col(rare), F.col(other_n) - F.col(other_rare))
    return 7 * most >= 3 * (F.col(n) + F.col(other_n))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, x: total + x)


def _may_link_by_pivot() -> Column:
    """``_may_link`` of (n, near, beyond) and (n_a, near_a, beyond_a), by what two members share with their list's pivot.

    Of the elements of a member that count, ``near`` are in the pivot's set, by parts of the universe, and ``beyond`` are
    not.  Of each part and of the rest two members share no more than the one with fewer holds.
    """
    inside = _total(F.zip_with("near", "near_a", lambda x, y: F.least(x, y)))
    return 7 * (inside + F.least("beyond", "beyond_a")) >= 3 * (F.col("n") + F.col("n_a"))


def _stars(entries: DataFrame, stands: DataFrame, on: list[str]) -> DataFrame:
    """(a, b), a < b: each entry of a list with the node that stands for it, if their sizes allow a link."""
    return (
        entries.join(stands, on)
        .filter((F.col("node") != F.col("stand")) & _may_link("n", "rare", "stand_n", "stand_rare"))
        .select(F.least("stand", "node").alias("a"), F.greatest("stand", "node").alias("b"))
    )


def _unchecked(pairs: DataFrame, checked: list[DataFrame]) -> DataFrame:
    for known in checked:
        pairs = pairs.join(known, ["a", "b"], "left_anti")
    return pairs


def _outside(long: DataFrame, labels: DataFrame) -> tuple[Stage, Stage, Stage]:
    """The entries of long lists with their components; lists of more than one, with the largest; the entries outside it."""
    placed = Stage(
        long.join(labels.select(F.col("id").alias("node"), "component"), "node", "left").select(
            "key", "node", "n", "rare", F.coalesce("component", "node").alias("component")
        ),
        "shingle-placed",
    )
    counted = placed.df.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = counted.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.count("*").alias("parts"))
    largest = Stage(largest.filter("parts > 1").select("key", "largest"), "shingle-largest")
    outside = placed.df.join(largest.df, "key").filter(F.col("component") != F.col("largest")).drop("largest")
    return placed, largest, Stage(outside, "shingle-outside", {"n": F.count("*")})


def placed(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, node, n, component) of every document, written, and the seed of the nodes' names.

    A component is named by one of its nodes; a document without words is in none.
    """
    docs = texts(docs)
    seed = 0
    while True:
        known = Stage(members(docs, seed), "shingle-members", {"entries": F.sum(F.floor(F.col("n") / 4) + 1), "shingles": F.sum("n")})
        # Names have 64 bits: should two texts share one, all are named anew.
        clash = known.df.groupBy("node").agg(F.min("proof").alias("low"), F.max("proof").alias("high")).filter("low <> high")
        if clash.isEmpty():
            break
        known.drop()
        seed += 1
    rows = known.df.select("doc_id", "node", "n")
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("wanted"), F.max("n").alias("n"))
    top = 4 * max(BOUNDARIES) // 3 + 1
    sizes = {r["n"]: r["count"] for r in nodes.filter(F.col("n") <= top).groupBy("n").count().collect()}
    entries = float(known.sums["entries"] or 0)
    # A set writes a quarter of its elements, and meets the short lists of the rest only.
    met = {f"s{i}": F.sum(F.col(f"c{i}") * F.least(F.col("m"), F.lit(SHORT)) / 8) for i in range(len(BOUNDARIES))}
    often = Stage(_cell_counts(docs, seed, float(known.sums["shingles"] or 0)), "shingle-counts", met)
    limit = boundary(sizes, entries, [float(often.sums[f"s{i}"] or 0) for i in range(len(BOUNDARIES))])
    heavy, counts = frequent_cells(often.df)
    often.drop()

    found = Stage(candidates(docs, seed, heavy, counts, limit, entries), "shingle-candidates")
    long = found.df.filter("kind = 1").select(
        "key", F.col("a").alias("node"), F.col("b").bitwiseAND(F.lit(0xFFFFFFFF)).alias("n"), F.shiftright("b", 32).alias("rare")
    )
    # Of a long list, one node per size band stands for the others at first: the one with the fewest rare elements.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)))
    banded = long.withColumn("band", band)
    first = F.min(F.struct("rare", "node", "n")).alias("s")
    stand = Stage(banded.groupBy("key", "band").agg(first).select("key", "band", "s.*"), "shingle-stands").df
    stars = _stars(banded, stand.withColumnsRenamed({"node": "stand", "n": "stand_n", "rare": "stand_rare"}), ["key", "band"])
    pairs = Stage(found.df.filter("kind = 0").select("a", "b").unionByName(stars).distinct(), "shingle-pairs")
    listed = _ends(pairs.df).unionByName(long.select("node")).distinct()
    outlines = known.df.filter("outline IS NOT NULL").select("node", "n", "outline").join(listed, "node", "left_semi")
    outlines = Stage(outlines.dropDuplicates(["node"]), "shingle-outlines").df

    def checked_links(among: DataFrame) -> Stage:
        near = Stage(close(among, outlines), "shingle-close", {"n": F.count("*")})
        if not near.sums["n"]:
            return near
        wanted = nodes.join(_ends(near.df).distinct(), "node", "left_semi").select("wanted")
        sets = Stage(sets_of(docs, Stage(wanted, "shingle-wanted").df, seed), "shingle-sets")
        real = Stage(linked(near.df, sets.df), "shingle-links", {"n": F.count("*")})
        sets.drop()
        return real

    links = checked_links(pairs.df)
    labels = Stage(_labels(links.df), "shingle-labels")

    checked = [pairs.df]
    for again in range(1, ROUNDS + 1):
        listed, largest, outside = _outside(long, labels.df)
        if not outside.sums["n"]:
            break
        # Those outside against one more member of the largest component, another one each time.
        inside = listed.df.join(largest.df, "key").filter(F.col("component") == F.col("largest"))
        other = F.min(F.struct(F.xxhash64("node", F.lit(again)).alias("h"), "node", "n", "rare")).alias("s")
        stand = inside.groupBy("key").agg(other).select(
            "key", F.col("s.node").alias("stand"), F.col("s.n").alias("stand_n"), F.col("s.rare").alias("stand_rare")
        )
        stand = Stage(stand, "shingle-stands").df
        fresh = Stage(_unchecked(_stars(outside.df, stand, ["key"]).distinct(), checked), "shingle-pairs")
        checked.append(fresh.df)
        more = checked_links(fresh.df)
        if more.sums["n"]:
            links = Stage(links.df.unionByName(more.df), "shingle-links")
            labels = Stage(_labels(links.df), "shingle-labels")
    # What is still outside, against those of its lists that can link by what both share with one member of the list.
    listed, largest, outside = _outside(long, labels.df)
    if outside.sums["n"]:
        core = listed.df.join(largest.df, "key").filter(F.col("component") == F.col("largest"))
        pivots = Stage(core.groupBy("key").agg(F.min(F.struct("rare", "node")).alias("p")).select("key", F.col("p.node").alias("pivot")), "shingle-pivots")
        entries = Stage(listed.df.join(pivots.df, "key"), "shingle-entries").df
        measured = Stage(entries.select("node", "pivot").distinct(), "shingle-measured").df
        of_both = measured.select("node").unionByName(measured.select(F.col("pivot").alias("node"))).distinct()
        wanted = Stage(nodes.join(of_both, "node", "left_semi").select("wanted"), "shingle-wanted").df
        sets = Stage(sets_of(docs, wanted, seed), "shingle-sets")
        shares = Stage(overlaps(measured, sets.df, heavy, counts), "shingle-overlaps").df
        # In a list of infrequent elements no element is counted as rare, and all count.
        near = F.when(F.col("rare") == 0, F.col("shared")).otherwise(F.col("often"))
        entries = entries.join(shares, ["node", "pivot"]).select("key", "node", "n", "rare", "component", near.alias("near"))
        entries = Stage(entries.withColumn("beyond", F.col("n") - F.col("rare") - _total(F.col("near"))), "shingle-near").df
        sets.drop()
        against = entries.join(largest.df, "key").filter(F.col("component") != F.col("largest")).select(
            "key",
            F.col("node").alias("a"),
            *[F.col(c).alias(f"{c}_a") for c in ("n", "rare", "near", "beyond")],
            F.col("component").alias("c_a"),
        )
        rest = (
            against.join(entries, "key")
            .filter((F.col("component") != F.col("c_a")) & _may_link("n", "rare", "n_a", "rare_a") & _may_link_by_pivot())
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
            .distinct()
        )
        more = checked_links(Stage(_unchecked(rest, checked), "shingle-rest").df)
        if more.sums["n"]:
            labels = Stage(_labels(links.df.unionByName(more.df)), "shingle-labels")
    component = F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("component")
    named = labels.df.select(F.col("id").alias("node"), "component")
    return Stage(rows.join(named, "node", "left").select("doc_id", "node", "n", component), "shingle-rows").df, seed


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows, _ = placed(docs)
    least = Stage(rows.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("least")), "shingle-least")
    return rows.join(least.df, "component", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def op10(docs: DataFrame) -> DataFrame:
    return components(docs)


def named(rows: DataFrame, seed: int) -> DataFrame:
    """Rows (doc, id) with the ``name`` of their node, null where the text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in _strings(batches):
            said = [shingler.words(t or "") for t in batch.column(2).to_pylist()]
            names = [shingler.node(words, seed)[0] if words else None for words in said]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.int64())], names=["doc", "id", "name"])

    schema = StructType([*rows.select("doc", "id").schema.fields, StructField("name", LongType())])
    return rows.select("doc", "id", F.col("doc.text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but one row of each component: that of the smallest id, one without an id last.

    All columns are kept, whatever their names.  Of rows that share the smallest id one stays, and so do all rows whose
    text has no words.
    """
    rows, seed = placed(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    # Written before it is joined, so that the adaptive join may split a large component.
    first = Stage(rows.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first")), "near-first").df
    stays = F.col("component").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node")))
    node = F.when(F.col("component").isNotNull(), F.col("node")).alias("node")
    decided = rows.join(first, "component", "left").select("doc_id", node, stays.cast("int").alias("stays"))
    return without(docs, Stage(decided, "near-decided").df, lambda held: named(held, seed), "node")
