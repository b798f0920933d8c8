"""Mixing sources to target weights by hash-threshold histograms.

A source whose target is ``k`` times its size and some more takes each document ``k`` times, and once more those
documents that fit, in the order of a hash, into what is left of the budget.  No document is sorted for that: sizes
are summed by source and hash bucket, the bucket in which the budget runs out is found, and only that bucket is
split further, until the one hash is known at which it runs out.  Documents below it are in.  What is then left is
offered in the same way to the documents above it that are small enough, so that budgets nest until nothing fits.

A source's state is one row: histograms are partially aggregated, so a hot source costs no more than another.
Everything is JVM-side, and the same rows give the same mix however they are split.

Defined cases: null and empty texts have size 0 and are never taken; null sources are one source, the last; rows with
the same id and text are taken together or not at all; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import text_of, word_count
from tamarack.operators.ordering import global_index
from tamarack.staging import Stage

WEIGHTS = (5, 2, 1)  # by source, repeating
MOST_COPIES = 3
HASH_BITS, LEVEL_BITS = 60, 12


def mixing_hash(doc_id: Column, text: Column) -> Column:
    """60 bits from a document's id and text."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), text))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) of (source, source_size): shares of the total by weight, none above ``most`` times
    its source's size; what is cut is shared among the others by weight until none is above."""
    # Null last, and apart from the empty string.
    keyed = sizes.select("source", "source_size", F.struct(F.col("source").isNull().alias("n"), F.col("source").alias("s")).alias("by"))
    numbered = global_index(keyed, ["by"], index="nth")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights)).cast("int") + 1)
    stage = Stage(numbered.select("source", "source_size", cycle.alias("weight")), "mix-sources")
    capped, level = -1, 0.0
    whole = stage.df.agg(F.sum("source_size")).first()[0] or 0
    most_of = F.col("source_size") * most
    while True:
        above = F.col("weight") * level > most_of
        now = stage.df.agg(
            F.sum(above.cast("long")), F.sum(F.when(above, most_of)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if (now[0] or 0) == capped or not now[2]:
            break
        capped, level = now[0], (whole - (now[1] or 0)) / now[2]
    return stage.df.select("source", "source_size", F.least(F.col("weight") * level, most_of.cast("double")).alias("target"))


def _step(docs: DataFrame, state: DataFrame) -> DataFrame:
    """One histogram for every source that isn't settled: narrow the bucket, or close a budget and open the next."""
    inside = F.expr(f"shiftright(h, shift + {LEVEL_BITS}) = shiftright(low, shift + {LEVEL_BITS})")
    eligible = docs.join(state.filter(~F.col("done")), F.col("source") == F.col("src")).filter(
        (F.col("h") > F.col("last")) & (F.col("size") <= F.col("budget")) & inside
    )
    histogram = eligible.groupBy("src", F.expr(f"shiftright(h, shift) & {2**LEVEL_BITS - 1}").alias("bucket")).agg(
        F.sum("size").alias("words"), F.min("h").alias("least"), F.max("h").alias("greatest")
    )
    below = F.sum("words").over(Window.partitionBy("src").orderBy("bucket")) - F.col("words")
    cut = (
        histogram.withColumn("below", below)
        .join(state.select("src", "budget", "used"), "src")
        .filter(F.col("used") + F.col("below") + F.col("words") > F.col("budget"))
        .groupBy("src")
        .agg(F.min_by(F.struct("below", "least", "greatest"), "bucket").alias("c"))
    )
    joined = state.join(cut, "src", "left")
    found, single = F.col("c").isNotNull(), F.col("c.least") == F.col("c.greatest")
    taken = F.col("used") + F.col("c.below")
    closes = found & single
    rest = F.col("budget") - taken
    interval = lambda end: F.struct(F.col("last").alias("above"), end.alias("under"), F.col("budget").alias("up_to"))
    after = (
        # Not found: all that is eligible fits.
        F.when(F.col("done"), F.struct("budget", "used", "last", "low", "shift", "taken_in", "done"))
        .when(
            closes,
            F.struct(
                rest.alias("budget"),
                F.lit(0).cast("long").alias("used"),
                F.col("c.least").alias("last"),
                F.lit(0).cast("long").alias("low"),
                F.lit(HASH_BITS - LEVEL_BITS).alias("shift"),
                F.array_append("taken_in", interval(F.col("c.least"))).alias("taken_in"),
                (rest <= 0).alias("done"),
            ),
        )
        .when(
            found,
            F.struct(
                "budget",
                taken.alias("used"),
                "last",
                F.expr("shiftleft(shiftright(c.least, shift), shift)").alias("low"),
                (F.col("shift") - LEVEL_BITS).alias("shift"),
                "taken_in",
                "done",
            ),
        )
        .otherwise(
            F.struct(
                "budget",
                "used",
                "last",
                "low",
                "shift",
                F.array_append("taken_in", interval(F.lit(2**HASH_BITS).cast("long"))).alias("taken_in"),
                F.lit(True).alias("done"),
            )
        )
    )
    return joined.select("src", "copies", after.alias("a")).select("src", "copies", "a.*")


def _source_key() -> Column:
    """A key of sources that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))


def _copies() -> Column:
    """How often a document of (size, h) is taken, by its source's (copies, taken_in)."""
    more = F.exists(
        "taken_in", lambda i: (F.col("h") > i["above"]) & (F.col("h") < i["under"]) & (F.col("size") <= i["up_to"])
    ) & (F.col("size") > 0)
    return F.when(F.col("size") > 0, F.col("copies") + more.cast("long")).otherwise(0)


def settled_sources(docs: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, source, size, h), and one row per source that says which of them are taken how often."""
    sized = Stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_of().alias("text")
        ).select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing_hash(F.col("doc_id"), F.col("text")).alias("h")),
        "mix-sizes",
    )
    goals = Stage(targets(sized.df.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets").df
    key = _source_key()
    narrow = sized.df.filter(F.col("size") > 0).select(key.alias("source"), "size", "h")
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    budget = F.floor(F.col("target") - F.col("copies") * F.col("source_size")).cast("long")
    state = Stage(
        goals.withColumn("copies", whole)
        .withColumn("budget", budget)
        .select(
            key.alias("src"),
            "copies",
            "budget",
            F.lit(0).cast("long").alias("used"),
            F.lit(-1).cast("long").alias("last"),
            F.lit(0).cast("long").alias("low"),
            F.lit(HASH_BITS - LEVEL_BITS).alias("shift"),
            F.array().cast("array<struct<above:bigint,under:bigint,up_to:bigint>>").alias("taken_in"),
            (F.col("budget") <= 0).alias("done"),
        ),
        "mix-state",
        {"open": F.sum((F.col("budget") > 0).cast("long"))},
    )
    still = {"open": F.sum((~F.col("done")).cast("long"))}
    while state.sums["open"]:
        following = Stage(_step(narrow, state.df), "mix-state", still)
        state.drop()
        state = following
    return sized.df, goals.withColumn("src", key).join(state.df.select("src", "copies", "taken_in"), "src").drop("source")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, h, source, size, source_size, target, copies) of every document: how often the mix takes it."""
    sized, settled = settled_sources(docs, weights, most)
    return (
        sized.withColumn("src", _source_key())
        .join(settled, "src")
        .select("doc_id", "h", "source", "size", "source_size", "target", _copies().alias("copies"))
    )


def op6(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def apply_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns they came with, whatever their names.

    What a source takes is one row, so a document's size and hash tell in its own row how often it is taken; no text moves.
    """
    _, settled = settled_sources(docs, WEIGHTS, MOST_COPIES)
    settled = Stage(settled.select("src", "copies", "taken_in"), "mix-settled").df
    rows = docs.select(
        F.struct("*").alias("doc"), F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("id"), text_of().alias("text")
    )
    held = rows.select("doc", _source_key().alias("src"), word_count(F.col("text")).alias("size"), mixing_hash(F.col("id"), F.col("text")).alias("h"))
    taken = held.join(settled, "src").select("doc", _copies().alias("times")).filter("times > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("doc.*")


ORACLE = f"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS id, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), water AS (
  SELECT 0 AS round, -1::BIGINT AS capped, 0.0::DOUBLE AS level
  UNION ALL
  SELECT round + 1, now.n, now.level FROM water, LATERAL (
    SELECT count(*) FILTER (weight * water.level > 3 * source_size) AS n,
      ((sum(source_size) - coalesce(sum(3 * source_size) FILTER (weight * water.level > 3 * source_size), 0))::DOUBLE
        / sum(weight) FILTER (NOT weight * water.level > 3 * source_size)) AS level
    FROM sources) AS now
  WHERE now.n <> water.capped AND round < 50
), goals AS (
  SELECT source, source_size, least(weight * level, 3.0 * source_size)::DOUBLE AS target
  FROM sources, (SELECT level FROM water ORDER BY round DESC LIMIT 1)
), budgets AS (
  SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS copies FROM goals
), queue AS (
  SELECT s.id, s.source, s.size, row_number() OVER (PARTITION BY s.source ORDER BY h, s.id) AS place
  FROM sized s WHERE s.size > 0
), filled AS (
  SELECT b.source, 0::BIGINT AS place, NULL::BIGINT AS id, floor(target - copies * source_size)::BIGINT AS rest, FALSE AS taken
  FROM budgets b
  UNION ALL
  SELECT f.source, q.place, q.id, f.rest - CASE WHEN q.size <= f.rest THEN q.size ELSE 0 END, q.size <= f.rest
  FROM filled f JOIN queue q ON q.source IS NOT DISTINCT FROM f.source AND q.place = f.place + 1
)
SELECT s.doc_id, s.size, b.source_size, b.target,
  (s.size * (b.copies + coalesce(f.taken, FALSE)::BIGINT))::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN filled f ON f.id = s.id
"""
