"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder; the optimizer prunes its columns and pushes filters into it."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
