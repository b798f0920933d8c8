"""Labelled rows to learn from: a bounded, reproducible sample of those that are not held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document may not be learnt from: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents that aren't held out, chosen by a hash of the id.

    Rows without id or label are left out; of several labels of a document the smallest counts, of several rows
    of a document each is taken.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    # Bounded by ``most`` rows of two numbers, so it may be broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.join(F.broadcast(chosen), "doc_id")
