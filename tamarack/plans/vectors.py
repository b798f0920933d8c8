"""Vector queries on the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions import vectors as vec
from tamarack.operators.metrics import prediction_quality
from tamarack.operators.neighbors import knn_outliers, knn_outliers_pruned, nearest
from tamarack.plans.registry import registry
from tamarack.sources.lines import dropped_labelled, labelled_rows
from tamarack.sources.tables import table
from tamarack.staging import spread

QUERIES, ORACLES, register = registry()


def points(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spread(table(spark, sf, "embeddings"), "vec_id")
    return vectors.select(F.col("vec_id").alias("id"), vec.as_doubles(F.col("embedding")).alias("features"))


def _pairs_sql(k: int) -> str:
    return f"""
    p AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    near AS (
        SELECT vec_id, other, distance, place FROM (
            SELECT a.vec_id, b.vec_id AS other, list_distance(a.v, b.v) AS distance,
                   ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS place
            FROM p a JOIN p b ON a.vec_id <> b.vec_id) WHERE place <= {k})
    """


_OUTLIERS = f"""
    WITH {_pairs_sql(10)}
    SELECT vec_id AS id, ROUND(MAX(distance), 9) AS score FROM near GROUP BY 1
    ORDER BY MAX(distance) DESC, 1 LIMIT 5
"""


@register("knn_outliers", _OUTLIERS)
def outliers(spark: SparkSession, sf: str) -> DataFrame:
    return knn_outliers(points(spark, sf)).withColumn("score", F.round("score", 9))


@register("knn_outliers_pruned", _OUTLIERS)
def outliers_pruned(spark: SparkSession, sf: str) -> DataFrame:
    return knn_outliers_pruned(points(spark, sf), sample=128).withColumn("score", F.round("score", 9))


@register(
    "nearest_vectors",
    f"WITH {_pairs_sql(5)} SELECT vec_id, other, place, ROUND(distance, 9) AS distance FROM near",
)
def nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    p = points(spark, sf)
    near = nearest(p, p, 5, exclude_self=True)
    return near.select(
        F.col("query_id").alias("vec_id"),
        F.col("point_id").alias("other"),
        F.col("place").cast("long").alias("place"),
        F.round("distance", 9).alias("distance"),
    )


_CELLS = "cells AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings)"


@register(
    "row_standardised",
    f"""
    WITH {_CELLS}, s AS (SELECT vec_id, AVG(x) AS m, stddev_pop(x) AS d FROM cells GROUP BY 1)
    SELECT c.vec_id, c.pos, ROUND((c.x - s.m) / CASE WHEN s.d = 0 THEN 1 ELSE s.d END, 9) AS x
    FROM cells c JOIN s ON s.vec_id = c.vec_id
    """,
)
def row_standardised(spark: SparkSession, sf: str) -> DataFrame:
    rows = points(spark, sf).select("id", vec.standardise(F.col("features")).alias("z"))
    return rows.select(F.col("id").alias("vec_id"), F.posexplode("z").alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), F.round("x", 9).alias("x")
    )


@register(
    "vector_functions",
    f"""
    WITH {_CELLS}
    SELECT vec_id, ROUND(sqrt(SUM(x * x)), 9) AS length, ROUND(SUM(x * pos), 9) AS ramp,
           ROUND(SUM((x - pos) * (x - pos)), 6) AS squared_gap, ROUND(SUM(least(10 * x, 1)), 9) AS clipped
    FROM cells GROUP BY 1
    """,
)
def vector_functions(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("features")
    ramp = F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: i.cast("double"))
    return points(spark, sf).select(
        F.col("id").alias("vec_id"),
        F.round(vec.norm(x), 9).alias("length"),
        F.round(vec.dot(x, ramp), 9).alias("ramp"),
        F.round(vec.squared_norm(vec.subtract(x, ramp)), 6).alias("squared_gap"),
        F.round(vec.vsum(vec.clip_vector(F.transform(x, lambda v: v * 10))), 9).alias("clipped"),
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """(vec_id, label, value): each embedding as an ``id,class,x1,...`` line."""
    e = table(spark, sf, "embeddings")
    cells = F.array_join(vec.as_doubles(F.col("embedding")).cast("array<string>"), ",")
    line = F.concat_ws(",", F.col("vec_id").cast("string"), F.when(F.col("label") < 5, "M").otherwise("B"), cells)
    return e.select("vec_id", "label", line.alias("value"))


@register(
    "dropped_labelled",
    """
    SELECT CASE WHEN label = 1 THEN 'field_count' WHEN label = 2 THEN 'number' ELSE 'kept' END AS outcome, COUNT(*) AS n
    FROM embeddings GROUP BY 1
    """,
)
def dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of label 1 get a field too many, in those of label 2 one number is none."""
    value = F.col("value")
    odd = F.when(F.col("label") == 1, F.concat(value, F.lit(",7"))).when(F.col("label") == 2, F.regexp_replace(value, ",[^,]*$", ",n/a"))
    return dropped_labelled(_lines(spark, sf).select(odd.otherwise(value).alias("value")), n_features=64)


@register(
    "labelled_rows",
    """
    SELECT CAST(vec_id AS VARCHAR) AS item, CASE WHEN label < 5 THEN 1::BIGINT ELSE -1 END AS label,
           len(embedding) AS n_features, ROUND(list_sum(CAST(embedding AS DOUBLE[])), 9) AS total
    FROM embeddings
    """,
)
def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings written as ``id,class,x1,...`` lines and parsed back."""
    rows = labelled_rows(_lines(spark, sf).select("value"), n_features=64)
    return rows.select(
        "item",
        F.col("label").cast("long").alias("label"),
        F.size("features").cast("long").alias("n_features"),
        F.round(vec.vsum(F.col("features")), 9).alias("total"),
    )


@register(
    "prediction_quality",
    """
    WITH s AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    t AS (
        SELECT label, v, list_max(v) AS top,
               list_max(v) + ln(list_sum(list_transform(v, lambda x: exp(x - list_max(v))))) - v[label + 1] AS loss,
               CASE WHEN list_max(v) > 0 THEN list_position(v, list_max(v)) - 1 ELSE -1 END AS predicted FROM s)
    SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN predicted = label THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
           ROUND(AVG(CASE WHEN predicted = label THEN 1.0::DOUBLE ELSE 0 END), 9) AS accuracy, ROUND(AVG(loss), 9) AS loss
    FROM t
    """,
)
def quality(spark: SparkSession, sf: str) -> DataFrame:
    """Each coordinate taken as the score of one class."""
    scored = table(spark, sf, "embeddings").select("label", vec.as_doubles(F.col("embedding")).alias("scores"))
    result = prediction_quality(scored)
    return result.withColumn("accuracy", F.round("accuracy", 9)).withColumn("loss", F.round("loss", 9))


@register(
    "softmax",
    """
    WITH c AS (
        SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS class FROM embeddings)
    SELECT vec_id, class, ROUND(exp(x) / SUM(exp(x)) OVER (PARTITION BY vec_id), 9) AS p FROM c
    """,
)
def softmax(spark: SparkSession, sf: str) -> DataFrame:
    rows = points(spark, sf).select("id", vec.softmax(F.col("features")).alias("p"))
    return rows.select(F.col("id").alias("vec_id"), F.posexplode("p").alias("class", "p")).select(
        "vec_id", F.col("class").cast("long").alias("class"), F.round("p", 9).alias("p")
    )
