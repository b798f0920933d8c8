"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_pairs(pairs: DataFrame, path: str, *, key: str, value: str, files: int) -> None:
    """``key<TAB>value`` text files: hash-partitioned by key, sorted by key inside each file."""
    line = F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string"))
    (
        pairs.select(key, value)
        .repartition(files, key)
        .sortWithinPartitions(key)
        .select(line.alias("value"))
        .write.text(path)
    )


def format_pair(left: str, right: str):
    """The text form ``(left, right)`` of a pair, for output only."""
    return F.concat(F.lit("("), F.col(left), F.lit(", "), F.col(right), F.lit(")"))
