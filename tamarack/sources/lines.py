"""Line-oriented text: plain lines, delimited records, pairs, tagged documents, labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.rows import computed_once
from tamarack.operators.ordering import running_totals
from tamarack.staging import Stage

# Layout of the delimited record.
RECORD_FIELDS = 11
KEY_FIELD = 1
TIME_FIELD = 3
AMOUNT_FIELD = 10
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a file or folder, in column ``value``; the path may be any store's URI."""
    return spark.read.text(path)


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``row_id`` = 0, 1, ... in file order, for rules that depend on row order.

    Lines are numbered where they are read: a first pass counts them by block of a file, the blocks' counts are added up in
    the order of files and blocks, and a line's number is its block's offset and its place in the block.  No text moves.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Ascending along the lines of a block, as one task reads it from its beginning to its end.
        F.monotonically_increasing_id().alias("seen"),
    )
    counted = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("seen").alias("first"))
    blocks = running_totals(counted, ["file", "block"], {"upto": "n"})
    offsets = Stage(blocks.select("file", "block", (F.col("upto") - F.col("n") - F.col("first")).alias("offset")), "line-blocks").df
    return lines.join(offsets, ["file", "block"]).select((F.col("offset") + F.col("seen")).alias("row_id"), "value")


def _fields(line: Column) -> Column:
    # Trailing empty fields do not count, as in a splitter that drops them.
    return F.split(F.rtrim(line, F.lit(",")), ",")


def checked_records(lines: DataFrame) -> DataFrame:
    """Every line with its parsed fields; a field that does not parse is NULL.

    Columns: value, n_fields, key, ts, amount.
    """
    lines = computed_once(lines.select("value"), _f=_fields(F.col("value")))
    well_formed = F.size("_f") == RECORD_FIELDS

    def field(position: int) -> Column:
        return F.when(well_formed, F.get("_f", F.lit(position)))

    parsed = F.struct(
        F.size("_f").alias("n_fields"),
        field(KEY_FIELD).alias("key"),
        F.try_to_timestamp(field(TIME_FIELD), F.lit(TIME_FORMAT)).alias("ts"),
        field(AMOUNT_FIELD).try_cast("double").alias("amount"),
    )
    return computed_once(lines, _p=parsed).select("value", "_p.*")


def timed_records(lines: DataFrame) -> DataFrame:
    """(key, ts, amount) of the lines with 11 fields, a valid time and a valid amount."""
    return checked_records(lines).filter("ts IS NOT NULL AND amount IS NOT NULL").select("key", "ts", "amount")


def keyed_records(lines: DataFrame) -> DataFrame:
    """(key, amount) of the lines with 11 fields and a valid amount; the time is not looked at."""
    return (
        checked_records(lines)
        .filter((F.col("n_fields") == RECORD_FIELDS) & F.col("amount").isNotNull())
        .select("key", "amount")
    )


def dropped_records(lines: DataFrame) -> DataFrame:
    """How many lines fell out, by the first rule that they broke."""
    outcome = (
        F.when(F.col("n_fields") != RECORD_FIELDS, "field_count")
        .when(F.col("ts").isNull(), "time")
        .when(F.col("amount").isNull(), "amount")
        .otherwise("kept")
    )
    return checked_records(lines).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def pair_records(lines: DataFrame) -> DataFrame:
    """(key, amount) of ``key<white space>amount`` lines, the text form of another job's output."""
    parts = F.split(F.regexp_replace("value", "\\s+\\z", ""), "\\s")
    return (
        lines.select(parts.alias("_p"))
        .filter(F.size("_p") == 2)
        .select(F.get("_p", F.lit(0)).alias("key"), F.get("_p", F.lit(1)).try_cast("double").alias("amount"))
        .filter(F.col("amount").isNotNull())
    )


def tagged_documents(lines: DataFrame) -> DataFrame:
    """(doc_id, text) of ``<doc id="..." url="...">text`` lines; other lines are dropped."""
    return lines.filter(F.col("value").rlike('id="(?s:.*?)" url=')).select(
        F.regexp_extract("value", 'id="((?s).*?)" url=', 1).alias("doc_id"),
        F.regexp_extract("value", '">((?s).*)\\z', 1).alias("text"),
    )


def _checked_labelled(lines: DataFrame, n_features: int) -> DataFrame:
    """The lines with _f, their fields, and _x, their numbers; a number that doesn't parse is NULL."""
    fields = lines.withColumn("_f", F.split("value", ","))
    return fields.withColumn("_x", F.transform(F.slice("_f", 3, n_features), lambda x: F.trim(x).try_cast("double")))


def _labelled_outcome(n_features: int) -> Column:
    return (
        F.when(F.col("_f").isNull() | (F.size("_f") != n_features + 2), "field_count")
        .when(F.exists("_x", lambda x: x.isNull()), "number")
        .otherwise("kept")
    )


def labelled_rows(lines: DataFrame, *, n_features: int = 30, positive: str = "M") -> DataFrame:
    """(item, label, features) of ``id,class,x1,...,xn`` lines; label +1 for ``positive``, else -1.

    Lines of another width and lines with something else than numbers fall out; ``dropped_labelled`` counts them.  A
    ``row_id`` column of the input is carried along.
    """
    carried = [c for c in lines.columns if c == "row_id"]
    return (
        _checked_labelled(lines, n_features)
        .filter(_labelled_outcome(n_features) == "kept")
        .select(
            *carried,
            F.get("_f", F.lit(0)).alias("item"),
            F.when(F.get("_f", F.lit(1)) == positive, 1).otherwise(-1).alias("label"),
            F.col("_x").alias("features"),
        )
    )


def dropped_labelled(lines: DataFrame, *, n_features: int = 30) -> DataFrame:
    """(outcome, n): how many labelled lines were kept, or fell out by the first rule that they broke."""
    return _checked_labelled(lines, n_features).groupBy(_labelled_outcome(n_features).alias("outcome")).agg(F.count("*").alias("n"))


def classed_lines(*corpora: DataFrame) -> DataFrame:
    """Union of per-class line corpora; class 0, 1, ... in the order given, ids stay per class."""
    labelled = [c.withColumn("label", F.lit(i)) for i, c in enumerate(corpora)]
    union = labelled[0]
    for other in labelled[1:]:
        union = union.unionByName(other)
    return union
