"""Periodic runs of words, found in texts compressed by a grammar.

A run is a stretch of words that repeats with a smallest period ``q`` over at least ``max(LEAST, TIMES * q)`` words and
can't be extended.  Within a task, texts are taken as word ids.  Recursive pairing builds one grammar for all of a
piece of the batch: in each round the pairs of neighbouring symbols that occur again become new symbols, a pair yielding
to a more frequent neighbour, so that equal stretches are parsed alike and the rules are as deep as the logarithm of the
longest.  What has no pair left that occurs again is paired neighbour by neighbour, up to one symbol for a stretch.

A run lies within some symbol and crosses the boundary of its two halves in the lowest that holds it, so runs are sought
once for each symbol and only across its boundary: from a side that holds half of the run, four words next to the
boundary occur again one period away, and such places are extended to both sides.  What is found is translated to every
place where the symbol is derived; intervals of one period that overlap by a period are merged, so that what a smaller
symbol cut off goes into the whole run.

Only stretches are compressed in which every eight words occur again in the same text, as all eight words of a run do
(a run of period q and length n >= 24, 3q holds any eight of its words a second time, q words away); no run is lost.

Texts are read whole and row by row; nothing is shuffled.  A task's memory is bounded by ``PIECE`` characters or, if that
is longer, by one text.

Defined cases: null and empty texts have no words and no run; null ids count as an empty id where it is decided which
texts are altered; repeated rows and ids are treated alike and each returned; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tamarack.llm.common import texts

LEAST, TIMES = 24, 3  # least length of a run, in words and in periods
GRAM = 8  # words that occur again wherever they stand in a run
ANCHOR = 4  # words that tell a period next to a boundary
ALTERED_OF = 10  # one text in so many is altered, by the crc32 of its id
PIECE = 4_000_000  # characters compressed together
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


class Run(NamedTuple):
    start: int
    length: int
    period: int


def altered(doc_id: int | None, words: list) -> list:
    """The words, one text in ten with its end replaced by repetitions of that end's beginning."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // ALTERED_OF
    if h % ALTERED_OF or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _grams(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` (a power of two) ids from each place on; the last places hold shorter ones."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    size = 1
    while size < width and size < len(h):
        after = np.zeros_like(h)
        after[:-size] = h[size:]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (after ^ (after >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        size *= 2
    return h


def repeating_stretches(ids: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of at least LEAST words whose every GRAM words occur again in their text."""
    n = len(ids)
    if n < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = np.zeros(n, bool)
    whole[: n - GRAM + 1] = text_of[: n - GRAM + 1] == text_of[GRAM - 1 :]
    at = np.flatnonzero(whole)
    keys = _grams(ids, GRAM)[at] ^ (text_of[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    again = np.zeros(n + 1, bool)
    again[at] = pd.Series(keys).duplicated(keep=False).to_numpy()
    # Gram by gram; a stretch ends where a gram doesn't occur again or where its text's last gram is.
    edge = np.diff(np.concatenate(([0], again.astype(np.int8))))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + GRAM - 1
    long = ends - starts >= LEAST
    return starts[long], ends[long]


def _chosen(keys: np.ndarray, open_: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of the pairs that may be replaced, those that neither neighbour outranks; of equal ones in a row every other."""
    n = len(keys)
    place = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = (keys[1:] != keys[:-1]) | ~open_[1:] | ~open_[:-1]
    even = (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0
    rank = np.where(open_, rank, -1)
    above = np.concatenate(([-1], rank[:-1])), np.concatenate((rank[1:], [-1]))
    return open_ & even & (rank >= above[0]) & (rank >= above[1])


class Grammar(NamedTuple):
    """Symbols of at least LEAST words where they are derived: symbol, place, words, words of its left half."""

    symbol: np.ndarray
    place: np.ndarray
    size: np.ndarray
    left: np.ndarray


def paired(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of the stretches [start, end) of ``ids``, by recursive pairing until each is one symbol."""
    size = ends - starts
    of = np.repeat(np.arange(len(starts)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)
    symbol, width = ids[place].astype(np.int64), np.ones(len(place), np.int64)
    following = int(ids.max(initial=0)) + 1
    out = []
    while len(symbol) > len(starts):
        near = of[:-1] == of[1:]
        key = (symbol[:-1] << 32) | symbol[1:]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        # Counted within the stretches only; a pair across a border isn't one.
        count = np.bincount(which[near], minlength=len(count))
        again = near & (count[which] > 1)
        # More frequent pairs first, then in the order of a hash, so that chains of ranks are short.
        order = np.lexsort((_grams(np.arange(len(count)), 1), count))
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(len(count))
        busy = np.zeros(len(starts), bool)
        busy[of[:-1][again]] = True
        # A stretch without any such pair is paired neighbour by neighbour.
        rest = near & ~busy[of[:-1]]
        taken = _chosen(key, again, rank[which]) | (rest & _alternate(of))
        at = np.flatnonzero(taken)
        _, new = np.unique(key[at], return_inverse=True)
        left = width[at].copy()
        symbol[at] = following + new
        following += int(new.max()) + 1
        width[at] += width[at + 1]
        large = width[at] >= LEAST
        out.append((symbol[at][large], place[at][large], width[at][large], left[large]))
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, width, place, of = symbol[keep], width[keep], place[keep], of[keep]
    if not out:
        return Grammar(*(np.empty(0, np.int64),) * 4)
    return Grammar(*(np.concatenate(c) for c in zip(*out, strict=True)))


def _alternate(of: np.ndarray) -> np.ndarray:
    """Every other pair of a stretch, from its first on."""
    n = len(of)
    place = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = of[1:] != of[:-1]
    return ((place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0)[:-1]


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """Length of what two arrays of one size begin with in common."""
    n, done, step = len(a), 0, 64
    while done < n:
        off = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(off):
            return done + int(off[0])
        done, step = done + step, step * 4
    return n


def _around(ids: np.ndarray, start: int, end: int, at: int, q: int) -> tuple[int, int]:
    """The longest stretch within [start, end) in which words ``q`` apart are equal and that holds ``at`` and ``at + q``."""
    right = _equal(ids[at : end - q], ids[at + q : end])
    left = _equal(ids[start:at][::-1], ids[start + q : at + q][::-1])
    return at - left, at + q + right


def crossing(ids: np.ndarray, grams: np.ndarray, start: int, boundary: int, end: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of what repeats LEAST words and TIMES periods long across a boundary of [start, end).

    ``grams`` are the hashes of ANCHOR ids; every place that they point to is compared on the ids.
    """
    most = (end - start) // TIMES
    # The words just after the boundary and their next occurrence, the words just before it and their last one.
    anchors = {}
    if boundary + 2 * ANCHOR <= end:
        after = grams[boundary + 1 : min(boundary + most, end - ANCHOR) + 1]
        anchors["after"] = np.flatnonzero(after == grams[boundary]) + 1
    here = boundary - ANCHOR
    if here - ANCHOR >= start:
        low = max(start, here - most)
        anchors["before"] = (here - low - np.flatnonzero(grams[low:here] == grams[here]))[::-1]
    found: list[tuple[int, int, int]] = []
    while any(len(a) for a in anchors.values()):
        side = min((a for a in anchors if len(anchors[a])), key=lambda a: anchors[a][0])
        q = int(anchors[side][0])
        anchors[side] = anchors[side][1:]
        s, e = _around(ids, start, end, boundary if side == "after" else here - q, q)
        if e - s < max(LEAST, TIMES * q) or any(q % p == 0 and a <= s and e <= b for a, b, p in found):
            continue
        found.append((s, e, q))
        # Multiples of the period that point into the run tell nothing else.
        for name, left in anchors.items():
            inside = (s <= boundary) & (boundary + left < e) if name == "after" else (here - left >= s) & (here < e)
            anchors[name] = left[(left % q != 0) | ~inside]
    return found


def merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Intervals (start, end, period): those of one period that share a period's words become one."""
    out: list[list[int]] = []
    for s, e, q in sorted(found, key=lambda f: (f[2], f[0], -f[1])):
        if out and out[-1][2] == q and out[-1][1] - s >= q:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, q])
    return [tuple(o) for o in out]


def runs_of(texts_: list[list]) -> list[list[Run]]:
    """The runs of each of several lists of words, by start and then period."""
    sizes = np.array([len(t) for t in texts_], np.int64)
    found: list[list[Run]] = [[] for _ in texts_]
    if not sizes.sum():
        return found
    words = pa.array([w for t in texts_ for w in t], pa.binary())
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    text_of = np.repeat(np.arange(len(texts_)), sizes)
    starts, ends = repeating_stretches(ids, text_of)
    if not len(starts):
        return found
    grammar = paired(ids, starts, ends)
    grams = _grams(ids, ANCHOR)
    order = np.lexsort((grammar.place, grammar.symbol))
    symbol, place = grammar.symbol[order], grammar.place[order]
    firsts = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1]))) if len(symbol) else []
    lasts = [*firsts[1:], len(symbol)] if len(symbol) else []
    pieces: dict[int, list[tuple[int, int, int]]] = {}
    for first, last in zip(firsts, lasts, strict=True):
        at, size, left = int(place[first]), int(grammar.size[order[first]]), int(grammar.left[order[first]])
        for s, e, q in crossing(ids, grams, at, at + left, at + size):
            for derived in place[first:last].tolist():
                pieces.setdefault(int(text_of[derived]), []).append((s - at + derived, e - at + derived, q))
    base = np.cumsum(sizes) - sizes
    for text, whole in pieces.items():
        runs = (Run(s - int(base[text]), e - s, q) for s, e, q in merged(whole))
        found[text] = sorted(runs, key=lambda r: (r.start, r.period))
    return found


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that a run repeats: of each run the first period's words stay."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        gone[r.start + r.period] += 1
        gone[r.start + r.length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]


def best(runs: list[Run]) -> Run | None:
    """The run of most periods; of equal ones the first, then that of the smaller period."""
    found = None
    for r in runs:  # by start, then period
        if found is None or r.length * found.period > found.length * r.period:
            found = r
    return found


def _rows(ids: list[int | None], bodies: list[bytes]) -> list[tuple]:
    texts_ = [altered(i, b.split()) for i, b in zip(ids, bodies, strict=True)]
    out = []
    for i, words, runs in zip(ids, texts_, runs_of(texts_), strict=True):
        top = best(runs)
        four = (None,) * 4 if top is None else (top.start, top.length, top.period, 1000 * top.length // top.period)
        listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs).encode()
        rest = b" ".join(collapsed(words, runs))
        out.append((i, len(runs), *four, hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest()))
    return out


def periodic_runs(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per document: its number of runs, the one of most periods, and digests of all runs and of what is left."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            first, held = 0, 0
            for last in range(1, len(ids) + 1):
                held += len(bodies[last - 1].as_buffer())
                if held >= piece or last == len(ids):
                    rows = _rows(ids[first:last], bodies.slice(first, last - first).to_pylist())
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)
                    first, held = last, 0

    return texts(docs).select("doc_id", "text").mapInArrow(scan, RESULT)


def op12(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs)
