"""Tables that are written to be asked for single keys.

Rows lie in folders by a hash of their key, sorted by it, with Bloom filters: a look-up opens one folder, skips files and
row groups by their smallest and largest keys and by their filters, and reads what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "key_bucket"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, *, key: str, buckets: int, files: int = 1) -> None:
    """Write rows for look-ups by ``key``, each of ``buckets`` folders in up to ``files`` files of adjoining keys."""
    placed = df.withColumn(BUCKET, _bucket(F.col(key), buckets))
    if files > 1:
        placed = placed.repartitionByRange(buckets * files, BUCKET, key)
    else:
        placed = placed.repartition(buckets, BUCKET)
    (
        placed.sortWithinPartitions(BUCKET, key)
        .write.partitionBy(BUCKET)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )


def look_up(spark: SparkSession, path: str, *, key: str, value, buckets: int) -> DataFrame:
    """The rows of one key."""
    table = spark.read.parquet(path)
    wanted = F.lit(value).cast(table.schema[key].dataType)
    return table.filter((F.col(BUCKET) == _bucket(wanted, buckets)) & (F.col(key) == wanted)).drop(BUCKET)
