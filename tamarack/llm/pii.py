"""Personal data: fixed patterns, widened by bootstrapped contextual extraction.

The fixed patterns give *base* spans (e-mail, IP, card and phone), which seed the bootstrap.  A seed's left
context (its last one and last two words) and right context (its first one and first two) become lexical patterns.
Patterns and the candidates beside them form a bipartite graph over the whole corpus.  Candidates are identifier-like
tokens and runs of such tokens with single spaces between, whose context is that of the run.  In each round a
pattern's confidence is the share of its instances that are believed to be of a kind, and a candidate's belief is the
noisy-or of its patterns, until nothing changes.  Candidates that reach the threshold become further spans, a run before the tokens in it; base
spans always stay.

Text is read once; what follows works on tables of occurrences, which are small.  Everything is JVM-side.

Defined cases: a null or empty text has no span; a null doc_id is a row of its own; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.  Ties between kinds go to the kind
listed first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import SPACE, texts
from tamarack.staging import Stage

# The kinds in their order, with patterns that find the leftmost non-overlapping matches of the
# documented ones.  A match can only begin where a run begins (or where the last match ended), and runs are taken
# possessively, so that a long run is read once.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# An identifier-like token: with a digit, an @, or a sign other than a hyphen or an apostrophe between its letters.
CANDIDATE = rf"(?<![^{SPACE}])(?=[^{SPACE}]*?(?:[0-9@]|\p{{L}}[^\p{{L}}\p{{M}}\p{{N}}{SPACE}'’-]++\p{{L}}))[^{SPACE}]++"
CONTEXT_CHARS = 80  # how far left and right of a span its context is looked for


def _found(text: Column, pattern: str, when: Column) -> Column:
    """Matches as (gap since the last match, value, left context, gap's beginning), and what follows the last one."""
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    near = F.lit(CONTEXT_CHARS)
    pairs = F.zip_with(
        gaps,
        values,
        lambda g, v: F.struct(
            F.length(g).cast("long").alias("gap"), v.alias("value"), F.right(g, near).alias("left"), F.left(g, near).alias("head")
        ),
    )
    return F.when(when & (F.size(values) > 0), pairs)


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(
        F.split(value, r"\."),
        lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3)
        & (F.concat(F.lit("0"), F.right(x, F.lit(3))).try_cast("int") <= 255),
    )

    def luhn(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    checked = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), luhn) % 10 == 0
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.when((n >= 12) & (n <= 19), checked).otherwise(False))
        .when(kind == "phone", (n >= 9) & (n <= 15))
        .otherwise(True)
    )


def _occurrences(found: DataFrame) -> DataFrame:
    """(uid, kind, start, end, value, left, right) of all matches and candidate tokens, whose kind is other."""
    each = None
    for kind in (*KINDS, "other"):
        rows = found.filter(F.col(kind).isNotNull()).select("uid", F.lit(kind).alias("kind"), F.posexplode(kind).alias("i", "m"))
        each = rows if each is None else each.unionByName(rows)
    length = F.length("m.value").cast("long")
    by_place = Window.partitionBy("uid", "kind").orderBy("i")
    each = each.withColumns({"end": F.sum(F.col("m.gap") + length).over(by_place), "right": F.lead("m.head").over(by_place)})
    return each.filter("m.value IS NOT NULL").select(
        "uid", "kind", (F.col("end") - length).alias("start"), "end", F.col("m.value").alias("value"), F.col("m.left").alias("left"), "right"
    )


def _free(base: DataFrame, tokens: DataFrame) -> DataFrame:
    """(uid, start, end, value, left, right) of the tokens that no base span of their document overlaps."""
    columns = ["uid", "start", "end", "value", "left", "right"]
    marked = base.select(*columns, F.lit(True).alias("is_base")).unionByName(tokens.select(*columns, F.lit(False).alias("is_base")))
    # The furthest end before it, the next start after.
    by_start = Window.partitionBy("uid").orderBy("start", F.col("is_base").desc(), "end")
    reach = F.max(F.when(F.col("is_base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    # From the end, as a frame that has no end is read anew for every row.
    from_end = Window.partitionBy("uid").orderBy(F.col("start").desc(), "is_base", F.col("end").desc())
    upcoming = F.min(F.when(F.col("is_base"), F.col("start"))).over(from_end.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("upcoming", F.col("end")) >= F.col("end"))
    return marked.withColumns({"reach": reach, "upcoming": upcoming}).filter(~F.col("is_base") & apart).select(*columns)


def _runs(tokens: DataFrame) -> DataFrame:
    """Runs of two tokens or more, with one space between each and the next."""
    by_start = Window.partitionBy("uid").orderBy("start")
    follows = (F.lag("end").over(by_start) == F.col("start") - 1) & (F.col("left") == " ")
    numbered = tokens.withColumn("begins", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("begins").over(by_start))
    parts = F.array_sort(F.collect_list(F.struct("start", "value")))
    return (
        numbered.groupBy("uid", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.concat_ws(" ", F.transform(parts, lambda t: t["value"])).alias("value"),
            F.min_by("left", "start").alias("left"),
            F.max_by("right", "start").alias("right"),
            F.count("*").alias("n"),
        )
        .filter("n > 1")
        .drop("run", "n")
    )


def _trimmed(candidates: DataFrame) -> DataFrame:
    """Candidates without the punctuation around them; a bracket that is closed inside of one stays."""
    opening = r"(?:\((?=[^()]*+\)[^A-Za-z0-9]*+[A-Za-z0-9]))?"
    lead = F.length(F.regexp_extract("value", rf"^([^A-Za-z0-9+@]*?){opening}[A-Za-z0-9+@]", 1))
    core = F.regexp_extract("value", rf"^[^A-Za-z0-9+@]*?({opening}[A-Za-z0-9+@].*?)[^A-Za-z0-9]*$", 1)
    return (
        candidates.withColumns({"start": F.col("start") + lead, "value": core})
        .withColumn("end", F.col("start") + F.length("value"))
        .filter(F.length("value") >= 4)
    )


def _patterns(left: Column, right: Column) -> Column:
    """The last one and two words before, and the first one and two after, lower case, as lexical patterns."""
    words = lambda text: F.filter(F.split(F.lower(text), rf"[{SPACE}]+"), lambda w: w != "")
    before, after = words(left), words(right)
    some = lambda n, x: F.when(n, F.concat_ws(" ", *x))
    found = F.array(
        some(F.size(before) >= 1, [F.element_at(before, -1), F.lit("_")]),
        some(F.size(before) >= 2, [F.element_at(before, -2), F.element_at(before, -1), F.lit("_")]),
        some(F.size(after) >= 1, [F.lit("_"), F.element_at(after, 1)]),
        some(F.size(after) >= 2, [F.lit("_"), F.element_at(after, 1), F.element_at(after, 2)]),
    )
    return F.filter(found, lambda w: w.isNotNull())


def bootstrap(
    base: DataFrame, candidates: DataFrame, *, min_seeds: int = 4, confidence: float = 0.8, tolerance: float = 1e-3
) -> DataFrame:
    """(value, kind) of candidate values that high-confidence patterns reach.

    ``base``: (kind, value, left, right) of seeds; ``candidates``: (value, left, right).  A pattern counts for a kind once it has
    ``min_seeds`` different believed instances; its confidence is their share of all its different instances.  Rounds go
    on until none changes a kind or raises a belief by more than the tolerance; beliefs never fall, so they settle.
    """
    seeds = base.select("value", "kind", F.lit(1.0).alias("belief")).distinct()
    edges = Stage(
        base.select("value", "left", "right")
        .unionByName(candidates.select("value", "left", "right"))
        .select("value", F.explode(_patterns(F.col("left"), F.col("right"))).alias("pattern"))
        .distinct(),
        "pii-edges",
    )
    first = Stage(seeds, "pii-belief").df
    sizes = edges.df.groupBy("pattern").agg(F.count("*").alias("instances"))
    # Patterns of one instance can't reach anything; the rest is what is iterated over.
    live = Stage(edges.df.join(sizes.filter(F.col("instances") > min_seeds), "pattern"), "pii-graph")
    edges.drop()
    found = Stage(first.limit(0), "pii-reached")
    moved = 1
    while moved:
        scored = (
            live.df.join(first.unionByName(found.df), "value")
            .groupBy("pattern", "kind")
            .agg(F.sum("belief").alias("mass"), F.count("*").alias("believed"), F.max("instances").alias("instances"))
            .select("pattern", "kind", (F.col("mass") / F.col("instances")).alias("conf"), "believed")
            .filter((F.col("believed") >= min_seeds) & (F.col("conf") >= confidence))
        )
        doubt = F.sum(F.log1p(-F.least("conf", F.lit(0.999))))
        reached = (
            live.df.join(scored, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(doubt)).alias("belief"))
            .join(first.select("value"), "value", "left_anti")
            .select("value", "kind", "belief", F.lit(False).alias("known"))
        )
        rank = F.struct("belief", F.translate("kind", "eicp", "zyxw"))
        better = (
            reached.unionByName(found.df.withColumn("known", F.lit(True)))
            .groupBy("value")
            .agg(F.max_by(F.struct("kind", "belief"), rank).alias("b"), F.max(F.when(F.col("known"), F.struct("belief", "kind"))).alias("before"))
        )
        changed = (F.col("b.belief") - F.col("before.belief") > tolerance) | (F.col("b.kind") != F.col("before.kind"))
        better = better.select("value", "b.kind", "b.belief", F.coalesce(changed, F.lit(True)).alias("changed"))
        following = Stage(better, "pii-reached", {"moved": F.sum(F.col("changed").cast("long"))})
        found.drop()
        moved = following.sums["moved"] or 0
        following.df, found = following.df.drop("changed"), following
    return found.df.filter(F.col("belief") >= confidence).select("value", "kind")


def find_pii(docs: DataFrame, **bootstrap_options) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, order, end, kind, value) by start and kind.

    Offsets are code points, ends exclusive.  ``base`` holds the fixed patterns' spans, ``spans`` those and the
    bootstrapped ones, which never overlap a base span.
    """
    text = F.col("text")
    digit = text.rlike("[0-9]")
    found = Stage(
        texts(docs).select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            *[_found(text, PATTERNS[k], text.contains(NEEDS[k]) & (digit if k != "email" else F.lit(True))).alias(k) for k in KINDS],
            _found(text, CANDIDATE, F.lit(True)).alias("other"),
        ),
        "pii-found",
    )
    occurrences = Stage(_occurrences(found.df).filter(_valid(F.col("kind"), F.col("value"))), "pii-occurrences").df
    base = occurrences.filter(F.col("kind") != "other")
    # Base spans overlap single tokens only, so a run is what stands between them.
    tokens = Stage(_free(base, occurrences.filter(F.col("kind") == "other")), "pii-tokens").df
    # Trimmed tokens may be free where the whole ones aren't.
    single = _free(base, _trimmed(occurrences.filter(F.col("kind") == "other")))
    free = Stage(single.unionByName(_trimmed(_runs(tokens)).select(single.columns)), "pii-free").df
    discovered = bootstrap(base.select("kind", "value", "left", "right"), free, **bootstrap_options)
    reached = free.join(discovered, "value").select("uid", "kind", "start", "end", "value")
    # A run goes before the tokens in it.
    wider = Window.partitionBy("uid").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(wider), F.lit(0))
    extra = reached.withColumn("covered", covered).filter(F.col("covered") <= F.col("start")).select(
        "uid", "kind", "start", "end", "value", F.lit(False).alias("is_base")
    )
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct("start", order.alias("order"), "end", "kind", "value")
    each = base.select("uid", "kind", "start", "end", "value", F.lit(True).alias("is_base")).unionByName(extra).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_base"), span))).alias("base"), F.array_sort(F.collect_list(span)).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>")
    return (
        found.df.select("uid", "doc_id")
        .join(each, "uid", "left")
        .select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))
    )


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def op1(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_pii(docs).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
