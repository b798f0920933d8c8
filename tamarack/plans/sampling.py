"""Samples, splits and character sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.hashing import sample_key
from tamarack.operators import sampling
from tamarack.operators.ordering import global_index
from tamarack.operators.sequences import char_sequences, padded_sequences
from tamarack.plans.learning import SAMPLE_FRACTION, SAMPLE_SEED, poisson_copies_sql
from tamarack.plans.registry import registry
from tamarack.sources.lines import classed_lines
from tamarack.sources.tables import table
from tamarack.staging import spread

QUERIES, ORACLES, register = registry()

SEED = 7
PER_CLASS = 300
HELD_OUT = 60
LANGUAGES = ("en", "fr", "de", "es")


def _key_sql(*ids: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', {', '.join(ids)})), 1, 13)) AS BIGINT)"


@register(
    "poisson_sample",
    f"SELECT doc_id, copies AS n FROM (SELECT doc_id, CAST({poisson_copies_sql('doc_id')} AS BIGINT) AS copies FROM documents) WHERE copies > 0",
)
def poisson_sample(spark: SparkSession, sf: str) -> DataFrame:
    """How often each document was drawn."""
    docs = table(spark, sf, "documents").select("doc_id")
    drawn = sampling.poisson_sample(docs, ids=["doc_id"], fraction=SAMPLE_FRACTION, seed=SAMPLE_SEED)
    return drawn.groupBy("doc_id").agg(F.count("*").alias("n"))


@register(
    "sample_exact",
    f"""
    SELECT o_orderpriority, o_orderkey, r AS sample_order FROM (
        SELECT o_orderpriority, o_orderkey,
               ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY {_key_sql('o_orderkey')}, o_orderkey) AS r
        FROM orders) WHERE r <= 500
    """,
)
def sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    drawn = sampling.sample_exact(orders, n=500, ids=["o_orderkey"], seed=SEED, by="o_orderpriority")
    return drawn.withColumn("sample_order", F.col("sample_order").cast("long"))


@register(
    "draw_batch",
    f"""
    WITH d AS (SELECT range AS draw, {_key_sql('range')} / 4503599627370496.0::DOUBLE AS u FROM range(100)),
    i AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
    SELECT d.draw, i.o_orderkey FROM d JOIN i ON i.i = CAST(floor(d.u * (SELECT COUNT(*) FROM orders)) AS BIGINT)
    """,
)
def draw_batch(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.draw_batch(table(spark, sf, "orders").select("o_orderkey"), size=100, ids=["o_orderkey"], seed=SEED)


@register(
    "shuffled",
    f"SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY {_key_sql('o_orderkey')}, o_orderkey) - 1 AS place FROM orders",
)
def shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """Each order's place in a seeded shuffle."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    return global_index(orders, [sample_key(SEED, F.col("o_orderkey")), F.col("o_orderkey")], index="place")


@register(
    "prefix_split",
    """
    SELECT vec_id, CASE WHEN ROW_NUMBER() OVER (ORDER BY vec_id) <= 400 THEN 'train' ELSE 'test' END AS split FROM embeddings
    """,
)
def prefix_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.split_before_rank(table(spark, sf, "embeddings").select("vec_id"), key="vec_id", n=400)


def corpora(spark: SparkSession, sf: str) -> DataFrame:
    """(label, doc_id, line_no, line): one corpus of lines per language."""
    docs = table(spark, sf, "documents")

    def corpus(language: str) -> DataFrame:
        text = spread(docs.filter(F.col("lang") == language).select("doc_id", "text"), "doc_id")
        return text.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))

    return classed_lines(*[corpus(x) for x in LANGUAGES])


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    return char_sequences(corpora(spark, sf), ids=["doc_id", "line_no"], per_class=PER_CLASS, seed=SEED)


_CASES = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(LANGUAGES))
_SEQUENCES = f"""
    pieces AS (
        SELECT lang, doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents),
    drawn AS (
        SELECT * FROM (
            SELECT *, CAST(CASE lang {_CASES} END AS BIGINT) AS label,
                   ROW_NUMBER() OVER (PARTITION BY lang ORDER BY {_key_sql('doc_id', 'line_no')}, doc_id, line_no) AS sample_order
            FROM pieces) WHERE sample_order <= {PER_CLASS}),
    sequences AS (
        SELECT label, doc_id, line_no, sample_order, line, list_filter(
                   list_transform(string_split(line, ''), lambda c: unicode(c)), lambda c: c < 256) AS codes
        FROM drawn WHERE NOT regexp_full_match(line, '\\s*'))
"""


@register(
    "char_sequences",
    f"""
    WITH {_SEQUENCES}
    SELECT label, doc_id, line_no, sample_order, len(codes) AS n_codes, md5(array_to_string(codes, ',')) AS digest FROM sequences
    """,
)
def char_sequences_query(spark: SparkSession, sf: str) -> DataFrame:
    return sequences(spark, sf).select(
        F.col("label").cast("long").alias("label"),
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        F.col("sample_order").cast("long").alias("sample_order"),
        F.size("codes").cast("long").alias("n_codes"),
        F.md5(F.array_join(F.col("codes").cast("array<string>"), ",")).alias("digest"),
    )


@register(
    "padded_sequences",
    f"""
    WITH {_SEQUENCES}
    SELECT label, doc_id, line_no, (SELECT MAX(length(line)) FROM sequences) AS length,
           (SELECT MAX(length(line)) FROM sequences) - len(codes) AS padding FROM sequences
    """,
)
def padded_sequences_query(spark: SparkSession, sf: str) -> DataFrame:
    padded = padded_sequences(sequences(spark, sf))
    return padded.select(
        F.col("label").cast("long").alias("label"),
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        F.size("padded").cast("long").alias("length"),
        F.size(F.filter("padded", lambda c: c < 0)).cast("long").alias("padding"),
    )


@register(
    "sample_split",
    f"""
    WITH {_SEQUENCES}
    SELECT label, doc_id, line_no, CASE WHEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY sample_order DESC) <= {HELD_OUT}
           THEN 'test' ELSE 'train' END AS split FROM sequences
    """,
)
def sample_split(spark: SparkSession, sf: str) -> DataFrame:
    """The last lines of each class's sample are held out."""
    marked = sampling.hold_out_last(sequences(spark, sf), n=HELD_OUT, order="sample_order", by="label")
    return marked.select(
        F.col("label").cast("long").alias("label"), "doc_id", F.col("line_no").cast("long").alias("line_no"), "split"
    )
