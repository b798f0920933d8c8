"""Seeded generated data sets, used as test and benchmark inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the planted-outlier cloud and of the coin flips.
CLOUD_DIMS = 100
CLOUD_INLIERS = 3000
CLOUD_OUTLIER_GROUPS = 19
FLIPS = 10
COIN_HEADS = (0.2, 0.6)


def planted_outliers(spark: SparkSession, *, seed: int) -> DataFrame:
    """(id, features): a Gaussian cloud at 0, then i points around (i, ..., i) for i = 1..19."""
    groups = CLOUD_OUTLIER_GROUPS
    n_outliers = groups * (groups + 1) // 2
    centre = (
        spark.range(1, groups + 1)
        .select(F.col("id").cast("double").alias("shift"), F.explode(F.sequence(F.lit(1), F.col("id"))).alias("_c"))
        .select("shift", (CLOUD_INLIERS + F.col("shift") * (F.col("shift") - 1) / 2 + F.col("_c") - 1).cast("long").alias("id"))
    )
    assert n_outliers == 190
    points = spark.range(CLOUD_INLIERS).select("id", F.lit(0.0).alias("shift")).unionByName(centre)

    def draw(batches):
        import numpy as np

        for b in batches:
            rows = [
                np.random.default_rng([seed, int(i)]).normal(shift, 1.0, CLOUD_DIMS).tolist()
                for i, shift in zip(b["id"], b["shift"])
            ]
            yield b[["id"]].assign(features=rows)

    return points.mapInPandas(draw, "id long, features array<double>")


def coin_flips(spark: SparkSession, *, rows: int = 100, seed: int) -> DataFrame:
    """(id, k, n): heads in ten flips of one of two coins, the coin drawn with equal odds."""

    def draw(batches):
        import numpy as np

        for b in batches:
            k = []
            for i in b["id"]:
                rng = np.random.default_rng([seed, int(i)])
                k.append(int(rng.binomial(FLIPS, COIN_HEADS[int(rng.integers(2))])))
            yield b.assign(k=k, n=FLIPS)

    return spark.range(rows).mapInPandas(draw, "id long, k long, n long")


def topic_corpus(
    spark: SparkSession, *, docs: int = 50, topics: int = 100, words: int = 2000, length: int = 2000, seed: int
) -> DataFrame:
    """(doc, topic, word, n): Dirichlet-multinomial documents over shared topic-word weights."""

    def draw(batches):
        import numpy as np

        word_odds = np.random.default_rng([seed, 0]).dirichlet(np.full(words, 0.1), topics)
        import pandas as pd

        for b in batches:
            out = []
            for d in b["id"]:
                rng = np.random.default_rng([seed, 1, int(d)])
                sizes = rng.multinomial(length, rng.dirichlet(np.full(topics, 0.1)))
                for t in np.flatnonzero(sizes):
                    n = rng.multinomial(sizes[t], word_odds[t])
                    w = np.flatnonzero(n)
                    out.append(pd.DataFrame({"doc": int(d), "topic": int(t), "word": w, "n": n[w]}))
            yield pd.concat(out) if out else pd.DataFrame({"doc": [], "topic": [], "word": [], "n": []})

    return spark.range(docs).mapInPandas(draw, "doc long, topic long, word long, n long")
