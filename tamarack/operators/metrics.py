"""Quality of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.vectors import first_positive_argmax, log_softmax_at


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("double")


def classification_metrics(df: DataFrame, *, actual: Column, predicted: Column, correct: Column) -> DataFrame:
    """One row: n, n_correct, accuracy, precision, recall, f1; a ratio over nothing is NULL."""
    counted = df.agg(
        F.count("*").cast("double").alias("n"),
        _count(correct).alias("n_correct"),
        _count(actual & predicted).alias("_tp"),
        _count(actual).alias("_actual"),
        _count(predicted).alias("_predicted"),
    )
    rated = counted.select(
        "n",
        "n_correct",
        F.try_divide("n_correct", "n").alias("accuracy"),
        F.try_divide("_tp", "_predicted").alias("precision"),
        F.try_divide("_tp", "_actual").alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", F.try_divide(F.lit(2.0) * p * r, p + r))


def margin_metrics(df: DataFrame, *, label: str = "label", score: str = "score") -> DataFrame:
    """Metrics of signed scores against labels +1/-1; a score of 0 is wrong for either label."""
    y, s = F.col(label), F.col(score)
    return classification_metrics(df, actual=y > 0, predicted=s > 0, correct=((s > 0) & (y > 0)) | ((s < 0) & (y < 0)))


def flag_metrics(df: DataFrame, *, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Metrics of 0/1 predictions against 0/1 labels."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return classification_metrics(df, actual=y, predicted=p, correct=F.col(label) == F.col(predicted))


def false_positives(df: DataFrame, *, identity: str, label: str = "label", predicted: str = "predicted", n: int = 10) -> DataFrame:
    """The n largest ids that were predicted 1 and are 0."""
    wrong = df.filter((F.col(predicted) == 1) & (F.col(label) == 0))
    return wrong.select(identity).orderBy(F.col(identity).desc()).limit(n)


def prediction_quality(df: DataFrame, *, label: str = "label", scores: str = "scores") -> DataFrame:
    """One row: n, n_correct, accuracy and mean cross-entropy of class scores ARRAY<DOUBLE>."""
    hit = first_positive_argmax(F.col(scores)) == F.col(label)
    return df.agg(
        F.count("*").alias("n"),
        F.sum(F.when(hit, 1).otherwise(0)).alias("n_correct"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"),
        F.avg(-log_softmax_at(F.col(scores), F.col(label))).alias("loss"),
    )
