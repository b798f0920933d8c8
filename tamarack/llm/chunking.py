"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes.  A chunk ends where the hash hits a mask: a strict one before the normal
size and a loose one after it (normalised chunking), within a least and a largest size.  A fingerprint is the set of a
text's chunk digests with their lengths; the likeness of two is the length of what they share over the length of all
that the first holds (containment).  An insertion moves only the borders next to it.

For the edited text a document needs the beginning of the next one in the order of ids.  Texts are sent once, in
compressed form, to slices of the id range, cut at percentiles; the first document of a slice is also sent to the slice
before it, so no slice needs another.

Defined cases: a null text is an empty one and has an empty fingerprint, and two empty ones have likeness 1, an empty and
another 0; null ids come last; rows of equal id are ordered by their texts' digests; a sole document is its own next
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import shuffle_parts, texts

LEAST, NORMAL, LARGEST = 8, 24, 128  # bytes of a chunk
STRICT, LOOSE = np.uint32(0xF8000000), np.uint32(0xE0000000)  # five and three of the hash's top bits
WINDOW = 32  # bytes that a 32-bit gear hash remembers
_random = np.random.default_rng(20)  # the gear table: any fixed random numbers do
GEAR = _random.integers(0, 2**32, 256, dtype=np.uint32)
ROWS = 256
LAST_ID = (1 << 63) - 1  # where null ids are put, after a document of that id


def gear_hashes(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: h = 2h + gear[byte], in 32 bits, summed by doubling windows."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < WINDOW and width < len(h):
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint32(width)
        h = h + shifted
        width *= 2
    return h


def borders(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear_hashes(data)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = (loose[(h[loose] & STRICT) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    out, start = [], 0
    while n - start > LEAST:
        i = bisect_left(strict, start + LEAST)
        end = strict[i] if i < len(strict) else n
        if end >= start + NORMAL:
            i = bisect_left(loose, start + NORMAL)
            end = min(loose[i] if i < len(loose) else n, start + LARGEST, n)
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunks(data: bytes) -> dict[str, int]:
    """Digest and length of the different chunks."""
    out: dict[str, int] = {}
    start = 0
    for end in borders(data):
        piece = data[start:end]
        out[hashlib.blake2b(piece, digest_size=6).hexdigest()] = end - start
        start = end
    return out


def fingerprint(data: bytes) -> str:
    """The chunks as digest and length, sorted, space-joined."""
    return written(chunks(data))


def written(found: dict[str, int]) -> str:
    return " ".join(f"{d}{n:02x}" for d, n in sorted(found.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of ``a``, by length, that ``b`` contains too."""
    if not a:
        return 1.0 if not b else 0.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


SENT = "slice int, id long, none boolean, tie string, own boolean, body binary"
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def with_next(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how near the edited and the next text are."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    base = texts(docs).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text", F.col("doc_id").isNull().alias("none"))
    # As many numbers as there are slices come to the driver.
    cuts = base.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or [0]
    # As doubles, ids keep their order, and equal ones stay together.
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    slicer = Bucketizer(splits=splits, inputCol="_place", outputCol="_slice")
    placed = lambda rows: slicer.transform(rows.withColumn("_place", F.col("id").cast("double")))
    heads = placed(base.select("id")).groupBy("_slice").agg(F.min("id").alias("id")).orderBy("_slice").collect()
    first = {int(h["_slice"]): h["id"] for h in heads}
    order = sorted(first)
    # The slice before, of each slice's first document; before the first comes the last.
    sent_back = {first[s]: order[i - 1] for i, s in enumerate(order)}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                rows = []
                for id_, text, slice_, none in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    raw = text.encode()
                    tie, body = hashlib.blake2b(raw, digest_size=16).hexdigest(), press.compress(raw)
                    rows.append((int(slice_), id_, none, tie, True, body))
                    if id_ in sent_back:
                        rows.append((sent_back[id_], id_, none, tie, False, body))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slice", "id", "none", "tie", "own", "body"]
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        held = None  # (slice, id or None, text, chunks) of the row whose next one is awaited
        done: list[tuple] = []

        def finish(text: str, found: dict[str, int]) -> None:
            _, id_, own_text, own = held
            new = edited(own_text, text)
            raw = new.encode()
            other = own if new == own_text else chunks(raw)
            done.append(
                (
                    id_,
                    len(own_text),
                    hashlib.sha256(raw).hexdigest(),
                    written(own),
                    written(other),
                    likeness(own, other),
                    likeness(own, found),
                )
            )

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [c.split()[0] for c in RESULT.split(", ")]
            columns = list(zip(*done, strict=True)) or [[]] * len(kinds)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                for slice_, id_, none, own, body in zip(*(batch.column(c).to_pylist() for c in ("slice", "id", "none", "own", "body")), strict=True):
                    raw = unpress.decompress(body)
                    text, found = raw.decode(), chunks(raw)
                    if held is not None and held[0] == slice_:
                        finish(text, found)
                        held = None
                    # What was sent back only ends its slice; further rows of that id were not awaited.
                    if own:
                        held = (slice_, None if none else id_, text, found)
                if done:
                    yield out()
        if done:
            yield out()

    sent = placed(base).select("id", "text", F.col("_slice").cast("int").alias("slice"), "none").mapInArrow(send, SENT)
    # Within a slice: its own rows by id and tie, then what was sent back to it.
    laid = sent.repartitionById(max(1, len(splits) - 1), "slice").sortWithinPartitions("slice", F.col("own").desc(), "id", "none", "tie")
    return laid.mapInArrow(meet, RESULT)


def op9(docs: DataFrame) -> DataFrame:
    return with_next(docs)
