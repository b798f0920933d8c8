"""Row-level helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used later.

    The optimizer copies a projected expression into every later use of it, which would split or
    parse a line again for each field and filter.  It does not look through a generator.
    """
    for name, value in columns.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df
