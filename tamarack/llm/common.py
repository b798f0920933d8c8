"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as the operators define it, inside a character class.
SPACE = r"\x20\x09-\x0D"

A_TO_Z, a_to_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of documents, whatever else they hold; null texts are empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words between white space."""
    return F.regexp_count(text, F.lit(rf"[^{SPACE}]+")).cast("long")
