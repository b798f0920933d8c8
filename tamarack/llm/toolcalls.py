"""Chat formatting: tool calls linked with their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on (conversation, identifier), both reduced to one row per identifier first,
so a conversation of any length is spread by its identifiers and never gathered.  Order: a call's place in its
conversation is a topological order as long as each call depends on earlier ones only.  Where a dependency points
forward, ``depth`` is raised step by step along the dependencies until (depth, place) is one; a depth above the number
of a conversation's forward dependencies means a cycle.  Arguments are checked against schema rows, one per tool and
argument.  Everything is JVM-side.

Defined cases: of calls (or results) with the same identifier the earliest place counts, then the smaller text, and
``n_calls``/``n_results`` tell how many there were; a null conversation is one of its own, a null or missing argument
document is an empty one, text that is no JSON object is reported as ``arguments: not an object``; a call without result has status
``no_result``, a result without call is returned with status ``orphan_result``; a call that needs one that isn't there is
invalid, with the error ``needs: no call <id>``; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.staging import Stage

# Of a schema row's type, what Spark calls the values that it admits.
TYPES = {
    "string": "^STRING$",
    "integer": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\\([0-9]+,0\\))$",
    "number": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


def _scope(conv: str = "conv_id") -> Column:
    """A key of conversations that is never null, and another one for null than for an empty name."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def _once(rows: DataFrame, payload: str, count: str, *more: str) -> DataFrame:
    """One row per (scope, call_id): the earliest."""
    first = F.min(F.struct("place", *more, payload))
    return rows.groupBy("scope", "call_id").agg(first.alias("r"), F.count("*").alias(count)).select("scope", "call_id", "r.*", count)


def order_depths(calls: DataFrame, needs: DataFrame) -> DataFrame | None:
    """(scope, call_id, depth, cyclic) such that (depth, place) is a topological order; None if all depths are 0.

    ``calls``: scope, call_id, place; ``needs``: scope, call_id, needed.  depth(call) is the largest over its
    dependencies of their depth, and one more where the dependency isn't earlier.
    """
    place = calls.select("scope", "call_id", "place")
    edges = Stage(
        needs.join(place, ["scope", "call_id"])
        .join(place.select("scope", F.col("call_id").alias("needed"), F.col("place").alias("at")), ["scope", "needed"])
        .select("scope", "call_id", "needed", (F.col("at") >= F.col("place")).cast("long").alias("step")),
        "call-edges",
        {"forward": F.sum("step")},
    )
    if not edges.sums["forward"]:
        return None
    # Only conversations with a forward dependency are worked on.
    bound = edges.df.groupBy("scope").agg(F.sum("step").alias("most")).filter("most > 0")
    bound = Stage(bound, "call-bounds").df
    live = Stage(edges.df.join(bound, "scope"), "call-live").df
    moved = Stage(live.filter("step = 1").select("scope", "call_id", F.lit(1).cast("long").alias("depth")).distinct(), "call-depths", {"n": F.count("*")})
    known = moved
    while moved.sums["n"]:
        raised = (
            live.join(moved.df.select("scope", F.col("call_id").alias("needed"), "depth"), ["scope", "needed"])
            # Beyond the bound a call is on or behind a cycle; it need not be raised further.
            .select("scope", "call_id", F.least(F.col("depth") + F.col("step"), F.col("most") + 1).alias("depth"))
            .groupBy("scope", "call_id")
            .agg(F.max("depth").alias("depth"))
        )
        old = known.df.select("scope", "call_id", F.col("depth").alias("old"))
        fresh = Stage(
            raised.join(old, ["scope", "call_id"], "left").filter("old is null or depth > old").select("scope", "call_id", "depth"),
            "call-depths",
            {"n": F.count("*")},
        )
        merged = Stage(
            known.df.unionByName(fresh.df).groupBy("scope", "call_id").agg(F.max("depth").alias("depth")), "call-depths"
        )
        if moved is not known:
            moved.drop()
        known.drop()
        known, moved = merged, fresh
    return (
        place.join(known.df, ["scope", "call_id"], "left")
        .join(bound, "scope", "left")
        .select(
            "scope",
            "call_id",
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            F.coalesce(F.col("depth") > F.col("most"), F.lit(False)).alias("cyclic"),
        )
    )


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """The calls with canonical arguments and sorted errors; schema rows: name, argument, type, required, min_length."""
    parsed = F.try_parse_json("arguments")
    shape = F.schema_of_variant(parsed)
    ok = shape.startswith("OBJECT")
    fields = F.when(ok, F.from_json("arguments", "map<string,variant>"))
    base = calls.withColumns({"is_object": ok, "fields": fields, "parsed": F.when(ok, parsed)})
    # A tool's schema is one small row; calls of one tool are many, so the join is left to the planner and adaptive splitting.
    rule = F.struct("argument", "type", "required", "min_length")
    tools = Stage(schemas.groupBy("name").agg(F.array_sort(F.collect_list(rule)).alias("rules")), "call-schemas").df
    value = lambda r: F.element_at(F.col("fields"), r["argument"])
    kinds = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])

    def check(r: Column) -> Column:
        v = value(r)
        kind = F.schema_of_variant(v)
        missing = v.isNull() | (kind == "VOID")
        wrong = ~F.rlike(kind, F.element_at(kinds, r["type"]))
        short = (kind == "STRING") & (F.length(F.variant_get(v, "$", "string")) < r["min_length"])
        problem = (
            F.when(missing & r["required"], "missing").when(missing, F.lit(None)).when(wrong, F.concat(F.lit("not "), r["type"])).when(short, "too short")
        )
        return F.concat(r["argument"], F.lit(": "), problem)

    unknown = F.transform(
        F.array_except(F.map_keys("fields"), F.transform("rules", lambda r: r["argument"])), lambda a: F.concat(a, F.lit(": unknown"))
    )
    found = F.filter(F.concat(F.transform("rules", check), unknown), lambda e: e.isNotNull())
    errors = (
        F.when(F.col("rules").isNull(), F.array(F.lit("tool: unknown")))
        .when(~F.coalesce("is_object", F.lit(False)), F.array(F.lit("arguments: not an object")))
        .otherwise(F.array_sort(found))
    )
    canonical = F.coalesce(F.to_json("parsed"), F.lit("{}"))
    return base.join(tools, "name", "left").select(*calls.columns, canonical.alias("canonical"), errors.alias("errors"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call identifier (and per orphaned result), with canonical JSON.

    ``calls``: conv_id, call_id, place, name, arguments (JSON text), needs (array of call ids); ``results``: conv_id,
    call_id, place, content.  (depth, place) orders a conversation's calls topologically.
    """
    asked = calls.select(
        _scope().alias("scope"), "conv_id", "call_id", "place", "name", F.coalesce("arguments", F.lit("{}")).alias("arguments"), "needs"
    ).filter(F.col("call_id").isNotNull())
    asked = Stage(_once(asked, "arguments", "n_calls", "conv_id", "name", "needs"), "calls").df
    got = _once(
        results.select(_scope().alias("scope"), "conv_id", "call_id", "place", "content").filter(F.col("call_id").isNotNull()),
        "content",
        "n_results",
        "conv_id",
    ).select("scope", "call_id", F.col("conv_id").alias("r_conv"), F.col("place").alias("r_place"), "content", "n_results")
    got = Stage(got, "call-results").df
    needs = asked.select("scope", "call_id", F.explode(F.array_distinct("needs")).alias("needed"))
    depths = order_depths(asked, needs)
    none = F.lit(0).cast("long")
    placed = asked.withColumns({"depth": none, "cyclic": F.lit(False)}) if depths is None else asked.join(depths, ["scope", "call_id"])
    checked = argument_errors(placed, schemas)
    known = asked.select("scope", F.col("call_id").alias("needed"))
    missing = Stage(needs.join(known, ["scope", "needed"], "left_anti"), "call-missing", {"n": F.count("*")})
    if missing.sums["n"]:
        said = F.array_sort(F.collect_set(F.concat(F.lit("needs: no call "), F.col("needed")))).alias("lacking")
        lacking = missing.df.groupBy("scope", "call_id").agg(said)
        all_errors = F.concat("errors", F.coalesce("lacking", F.array().cast("array<string>")))
        checked = checked.join(lacking, ["scope", "call_id"], "left").withColumn("errors", all_errors).drop("lacking")
    joined = checked.join(got, ["scope", "call_id"], "left")
    # Keys in code point order, no white space; a null content is left out by Spark and written as null here.
    text = F.concat(
        F.lit('{"arguments":'), F.col("canonical"),
        F.lit(',"id":'), _json("call_id"),
        F.lit(',"name":'), _json("name"),
        F.lit(',"needs":'), F.to_json(F.coalesce(F.array_sort("needs"), F.array().cast("array<string>"))),
        F.lit(',"result":'), _json("content"),
        F.lit("}"),
    )
    status = (
        F.when(F.col("cyclic"), "cyclic")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("n_results").isNull(), "no_result")
        .otherwise("linked")
    )
    linked = joined.select(
        "conv_id", "call_id", "place", "depth", status.alias("status"), F.concat_ws("; ", "errors").alias("errors"),
        "n_calls", F.coalesce("n_results", none).alias("n_results"), text.alias("json"),
    )
    orphans = got.join(asked.select("scope", "call_id"), ["scope", "call_id"], "left_anti").select(
        F.col("r_conv").alias("conv_id"), "call_id", F.col("r_place").alias("place"), none.alias("depth"),
        F.lit("orphan_result").alias("status"), F.lit("").alias("errors"), none.alias("n_calls"), "n_results",
        F.concat(F.lit('{"id":'), _json("call_id"), F.lit(',"result":'), _json("content"), F.lit("}")).alias("json"),
    )
    return linked.unionByName(orphans)


def _json(column: str) -> Column:
    """A string column as JSON, null as null."""
    return F.when(F.col(column).isNull(), "null").otherwise(
        F.regexp_replace(F.to_json(F.array(column)), r"^\[|\]$", "")
    )


def exchanges(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a user's turn calls ``reply``, the assistant's next turn answers it.

    The identifier names conversation and turn; a call needs the call two turns before it, if there is one.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    name = lambda turn: F.concat(F.lit("c"), conv, F.lit("-t"), turn.cast("string"))
    user, answer = turns.filter("role = 'user'"), turns.filter("role = 'assistant'")
    before = user.select(_scope().alias("scope"), (F.col("turn") + 2).alias("turn")).distinct()
    earlier = before.select("scope", "turn", F.lit(True).alias("follows"))
    # Canonical text at once: the two keys are in order.
    calls = user.withColumn("scope", _scope()).join(earlier, ["scope", "turn"], "left").select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.col("turn").alias("place"), F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn"))).alias("arguments"),
        F.when(F.col("follows"), F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    results = answer.select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("place"), F.col("text").alias("content"))
    return calls, results


def reply_schema(turns: DataFrame) -> DataFrame:
    """The schema of ``reply``: a prompt that isn't blank, and a turn number."""
    rows = [("reply", "prompt", "string", True, 1), ("reply", "turn", "integer", True, 0)]
    return turns.sparkSession.createDataFrame(rows, "name string, argument string, type string, required boolean, min_length int")


def op2(turns: DataFrame) -> DataFrame:
    slim = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return link_calls(*exchanges(slim), reply_schema(turns))


ORACLE = """
WITH ids AS (
  SELECT *, 'c' || coalesce(conv_id::VARCHAR, '') || '-t' AS stem FROM conversations
), calls AS (
  SELECT conv_id, stem || turn AS call_id, turn AS place, text, n_calls,
    CASE WHEN EXISTS (SELECT 1 FROM ids e WHERE e.role = 'user' AND e.stem = u.stem AND e.turn = u.turn - 2)
      THEN '["' || stem || (turn - 2) || '"]' ELSE '[]' END AS needs
  FROM (SELECT conv_id, stem, turn, min(text) AS text, count(*) AS n_calls FROM ids WHERE role = 'user' AND turn IS NOT NULL GROUP BY ALL) u
), results AS (
  SELECT conv_id, stem || (turn - 1) AS call_id, turn AS place, min(text) AS content, count(*) AS n_results
  FROM ids WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY ALL
), linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
    coalesce(c.place, r.place) AS place, 0::BIGINT AS depth,
    CASE WHEN c.call_id IS NULL THEN 'orphan_result' WHEN coalesce(c.text, '') = '' THEN 'invalid'
      WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN c.call_id IS NULL OR c.text <> '' THEN '' WHEN c.text IS NULL THEN 'prompt: missing' ELSE 'prompt: too short' END AS errors,
    coalesce(n_calls, 0)::BIGINT AS n_calls, coalesce(n_results, 0)::BIGINT AS n_results,
    coalesce(to_json(content)::VARCHAR, 'null') AS result, c.text, c.needs, c.call_id IS NULL AS orphan, c.place AS turn
  FROM calls c FULL JOIN results r ON c.call_id = r.call_id
)
SELECT conv_id, call_id, place, depth, status, errors, n_calls, n_results,
  CASE WHEN orphan THEN '{"id":"' || call_id || '","result":' || result || '}'
  ELSE '{"arguments":{' || coalesce('"prompt":' || to_json(text)::VARCHAR || ',', '') || '"turn":' || turn || '},"id":"' || call_id
    || '","name":"reply","needs":' || needs || ',"result":' || result || '}' END AS json
FROM linked
"""
