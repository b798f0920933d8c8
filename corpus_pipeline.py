"""A corpus pipeline: quality, exact copies, near copies, mixture, pieces.

``STAGES`` are applied in order; each gets all that the one before it kept, as a table.  The last returns each document of
the mixture with its pieces (a document that the mixture takes three times is there three times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import exact, jaccard, mixing, quality, sentencepiece_fst
from tamarack.sources.tables import table
from tamarack.staging import Stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of equal texts one document stays."""
    return exact.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each component of near copies one document stays."""
    return jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents as often as the mixture takes them."""
    return mixing.apply_mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the pieces of each document."""
    return sentencepiece_fst.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality", good_documents),
    ("exact", without_copies),
    ("near", without_near_copies),
    ("mixture", mixture),
    ("pieces", pieces),
]

# Classifier, similarity join and transducer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents of a folder; between them, tables in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Stage(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
