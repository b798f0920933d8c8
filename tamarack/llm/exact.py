"""Exact duplicates by minimal perfect hashing over historical digests.

A text's digest is the SHA-256 of its normalised form.  The distinct digests of the history are cut into shards of
bounded size, and each shard gets a minimal perfect hash: a cascade of bit arrays in which a key owns the one bit that
no other key of its level hit, numbered by rank.  A slot holds the full digest and the winner's locator, so a lookup
compares all 32 bytes: a digest that isn't in the history never passes for one.  Members are repeats of the slot's
winner; the rest are grouped by digest among themselves.

Only (row, digest) pairs move, never texts.  A shard that holds more looked-up rows than its fair share, for instance
because of one text with a third of all rows, is looked up by several tasks, each with a copy of the (small) shard.

Defined cases: a null text is an empty one; a null doc_id comes after all others; rows equal in id and text are
different rows, of which one stays; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import SPACE, shuffle_parts, text_of
from tamarack.staging import Stage

SHARD_KEYS = 65_536  # digests of a shard, about
GAMMA = 2.0  # bits of a level per key that is still unplaced
MOST_LEVELS = 40
INDEX_SCHEMA = "shard int, n long, sizes array<int>, bits binary, slots binary, ids array<long>, rows array<long>, rest array<int>"


def digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with runs of white space as one space."""
    return F.sha2(F.regexp_replace(text, rf"[{SPACE}]+", " "), 256)


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A hash per key and level; ``words``: the digest as four 64-bit words."""
    with np.errstate(over="ignore"):
        x = words[:, 0] ^ (words[:, 1] * np.uint64(2 * level + 1)) ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


class PerfectHash:
    """A minimal perfect hash over distinct 32-byte digests, as arrays."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, slots: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.slots, self.rest = sizes, bits, slots, rest
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, words: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash and, per key, its slot."""
        left, sizes, bits = np.arange(len(words)), [], []
        place = np.full(len(words), -1, dtype=np.int64)
        start = 0
        while len(left) and len(sizes) < MOST_LEVELS:
            size = max(1, int(GAMMA * len(left)))
            at = (_mixed(words[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            owned = np.bincount(at, minlength=size) == 1
            alone = owned[at]
            place[left[alone]] = start + at[alone]
            left = left[~alone]
            sizes.append(size)
            bits.append(owned)
            start += size
        flags = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
        rank = np.concatenate([[0], np.cumsum(flags)])
        slot = np.where(place >= 0, rank[place], -1)
        slot[left] = int(flags.sum()) + np.arange(len(left))  # of the few that no level could place
        slots = np.empty_like(words)
        slots[slot] = words
        return cls(np.array(sizes, dtype=np.int64), flags, slots, np.arange(len(words) - len(left), len(words))), slot

    def find(self, words: np.ndarray) -> np.ndarray:
        """Slots of digests, -1 for those that aren't members."""
        found = np.full(len(words), -1, dtype=np.int64)
        open_ = np.arange(len(words))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            found[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit]
        same = (found >= 0) & (self.slots[found] == words).all(axis=1) if len(self.slots) else np.zeros(len(words), dtype=bool)
        found[~same] = -1
        for slot in self.rest:
            found[(words == self.slots[slot]).all(axis=1)] = slot
        return found


def _words(digests: pd.Series) -> np.ndarray:
    joined = "".join(digests)
    return np.frombuffer(bytes.fromhex(joined), dtype="<u8").reshape(-1, 4)


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def _index_shard(keys: pd.DataFrame) -> pd.DataFrame:
    words = _words(keys["digest"])
    table, slot = PerfectHash.build(words)
    order = np.argsort(slot)
    ids = [None if i is None else int(i) for i in keys["doc_id"].to_numpy()[order]]
    return pd.DataFrame(
        {
            "shard": [int(keys["shard"].iloc[0])],
            "n": [len(keys)],
            "sizes": [table.sizes.astype(np.int32)],
            "bits": [np.packbits(table.bits).tobytes()],
            "slots": [table.slots.tobytes()],
            "ids": [ids],
            "rows": [keys["row"].to_numpy()[order].astype(np.int64)],
            "rest": [table.rest.astype(np.int32)],
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard.  ``history``: digest, doc_id, row of each distinct digest's winner."""
    # Ids travel as text: pandas would turn longs with nulls into doubles.
    keys = history.select(_shard(F.col("digest"), shards).alias("shard"), "digest", F.col("doc_id").cast("string").alias("doc_id"), "row")
    return keys.groupBy("shard").applyInPandas(_index_shard, INDEX_SCHEMA)


def _look_up(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    out = asked[["row", "doc_id", "digest"]].copy()
    out["keep_id"], out["keep_row"] = pd.array([pd.NA] * len(out), dtype="Int64"), pd.array([pd.NA] * len(out), dtype="Int64")
    if len(out) and len(index):
        held = index.iloc[0]
        sizes = np.asarray(held["sizes"], dtype=np.int64)
        bits = np.unpackbits(np.frombuffer(held["bits"], dtype=np.uint8), count=int(sizes.sum())).astype(bool)
        slots = np.frombuffer(held["slots"], dtype="<u8").reshape(-1, 4)
        found = PerfectHash(sizes, bits, slots, np.asarray(held["rest"], dtype=np.int64)).find(_words(out["digest"]))
        member = found >= 0
        ids, rows = pd.array(list(held["ids"]), dtype="Int64"), np.asarray(held["rows"], dtype=np.int64)
        out.loc[member, "keep_id"] = ids[found[member]]
        out.loc[member, "keep_row"] = rows[found[member]]
    return out


def look_up(asked: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(row, doc_id, digest, keep_id, keep_row): the winner of each looked-up digest, nulls for nonmembers."""
    asked = asked.select("row", F.col("doc_id").cast("string").alias("doc_id"), "digest", _shard(F.col("digest"), shards).alias("shard"))
    load = Stage(asked.groupBy("shard").agg(F.count("*").alias("load")), "shard-loads", {"all": F.sum("load")})
    # A task's fair share; a shard is spread over as many tasks as it has shares.
    share = max(1, 2 * (load.sums["all"] or 0) // max(shards, shuffle_parts(asked.sparkSession)))
    copies = load.df.select("shard", F.ceil(F.col("load") / share).cast("int").alias("copies"))
    spread = asked.join(copies, "shard").withColumn("part", F.expr("cast(pmod(xxhash64(row), copies) as int)"))
    held = index.join(copies, "shard").withColumn("part", F.explode(F.expr("sequence(0, copies - 1)")))
    # Selected anew, so that the two sides share no column.
    spread = spread.select("row", "doc_id", "digest", F.col("shard").alias("of_shard"), F.col("part").alias("of_part"))
    found = (
        held.groupBy("shard", "part")
        .cogroup(spread.groupBy("of_shard", "of_part"))
        .applyInPandas(_look_up, "row long, doc_id string, digest string, keep_id long, keep_row long")
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _first(rows: DataFrame) -> DataFrame:
    """(digest, doc_id, row): the winner among rows of equal texts, the smallest id."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return rows.groupBy("digest").agg(least.alias("w")).select("digest", "w.doc_id", "w.row")


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest) of documents; ``row`` numbers the rows of this table."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), digest(text_of()).alias("digest")
    )


def exact_duplicates(rows: DataFrame, history: DataFrame) -> DataFrame:
    """(row, doc_id, digest, keep_id, keep_row, group_size) of each row.

    ``rows``: row, doc_id, digest, all those to decide on; ``history``: the same of rows that were there before, whose
    winners take precedence.  The history may be a part of the rows.
    """
    spark = rows.sparkSession
    known = Stage(_first(history), "winners", {"n": F.count("*")})
    shards = max(1, -(-(known.sums["n"] or 0) // SHARD_KEYS), shuffle_parts(spark))
    index = Stage(build_index(known.df, shards), "perfect-hash").df
    known.drop()
    asked = Stage(look_up(rows, index, shards), "looked-up").df
    members, others = asked.filter(F.col("keep_row").isNotNull()), asked.filter(F.col("keep_row").isNull())
    fresh = Stage(_first(others).select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")), "fresh-winners").df
    decided = Stage(
        members.unionByName(others.drop("keep_id", "keep_row").join(fresh, "digest").select(asked.columns)), "decided"
    ).df
    # Written before it is joined, so that the adaptive join may split a large group.
    sizes = Stage(decided.groupBy("keep_row").agg(F.count("*").alias("group_size")), "group-sizes").df
    return decided.join(sizes, "keep_row").select("row", "doc_id", "digest", "keep_id", "keep_row", "group_size")


def deduplicated(docs: DataFrame) -> DataFrame:
    """Decisions on a table taken in two deliveries: what has an id up to the middle of the id range is history.

    Every row is decided on; the history's winners have smaller ids than any later row, so the smallest id stays.
    """
    rows = Stage(digests(docs), "digests", {"low": F.min("doc_id"), "high": F.max("doc_id")})
    low, high = rows.sums["low"], rows.sums["high"]
    middle = (low + high) // 2 if low is not None else 0
    return exact_duplicates(rows.df, rows.df.filter(F.col("doc_id") <= middle))


def op4(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names.

    Ids of which no row stays are taken out by the id alone, so that texts needn't move where those ids are few.  Rows
    without an id, and rows that share one, are told apart by their texts; of such with equal texts one stays.
    """
    stays = (F.col("row") == F.col("keep_row")).cast("int").alias("stays")
    decided = Stage(deduplicated(docs).select("doc_id", "digest", stays), "decisions").df
    return without(docs, decided, lambda rows: rows.withColumn("name", digest(F.coalesce(F.col("doc.text").cast("string"), F.lit("")))), "digest")


def without(docs: DataFrame, decided: DataFrame, named: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The documents that stay by (doc_id, ``name``, stays); ``named`` gives rows (doc, id) their ``name`` anew.

    Of rows of equal id and name one stays, if any does; a null name stands for rows that are all kept.
    """
    by_id = decided.groupBy("doc_id").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    shared = (F.col("stays") == 1) & (F.col("doc_id").isNull() | (F.col("n") > 1))
    out = Stage(
        by_id.filter((F.col("stays") == 0) | shared).select(F.col("doc_id").alias("gone"), shared.alias("shared")),
        "dropped-ids",
        {"shared": F.sum(F.col("shared").cast("long"))},
    )
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"))
    same = F.col("id").eqNullSafe(F.col("gone"))
    kept = rows.join(out.df, same, "left_anti").select("doc")
    if out.sums["shared"]:
        staying = decided.filter("stays = 1").select(F.col("doc_id").alias("of"), F.col(name).alias("called")).distinct()
        several = named(rows.join(out.df.filter("shared"), same, "left_semi"))
        one = several.join(staying, F.col("id").eqNullSafe(F.col("of")) & (F.col("name") == F.col("called")), "left_semi")
        kept = kept.unionByName(one.dropDuplicates(["id", "name"]).select("doc"))
        kept = kept.unionByName(several.filter("name IS NULL").select("doc"))
    return kept.select("doc.*")


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""
