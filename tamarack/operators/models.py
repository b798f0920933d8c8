"""A fitted text classifier as a written table, which later jobs read to score texts that it wasn't fitted on.

One row per vocabulary word: (word, idx, idf, mean, std, weight).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.learning import weight_table
from tamarack.operators.text import TermIndex, by_document, document_words, term_counts, term_frequency, text_size, with_totals
from tamarack.staging import broadcast_if_bounded

COLUMNS = "word string, idx long, idf double, mean double, std double, weight double"


def model_table(index: TermIndex, weights: np.ndarray) -> DataFrame:
    """The table of a model: the index's words with their training statistics and the weights found on them."""
    spark = index.vocab.sparkSession
    fitted = index.idf().join(index.moments(), "idx").join(weight_table(spark, weights), "idx")
    return index.vocab.select("word", "idx").join(fitted, "idx").select(*[c.split()[0] for c in COLUMNS.split(", ")])


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("errorifexists").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(path)


def score_texts(model: DataFrame, docs: DataFrame, *, size: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, score) of texts: their standardised TF-IDF, by the model's idf and moments, times its weights.

    ``size`` bounds the words of the model.  A text without any word of the vocabulary gets no score.
    """
    scale = F.when(F.col("std") > 0, F.col("weight") / F.col("std")).otherwise(F.lit(0.0))
    # One number for all texts: what absent words add up to.
    offset = model.agg(F.sum(F.col("mean") * scale)).first()[0] or 0.0
    laid = by_document(docs.select(doc, text), chars=text_size(docs, text=text)[1], doc=doc)
    counts = term_counts(document_words(laid, doc=doc, text=text), model, size=size, doc=doc)
    tf = term_frequency(with_totals(counts, doc=doc), doc=doc)
    worth = broadcast_if_bounded(model.select("idx", (F.col("idf") * scale).alias("worth")), size)
    return tf.join(worth, "idx").groupBy(doc).agg((F.sum(F.col("tf") * F.col("worth")) - F.lit(offset)).alias("score"))
