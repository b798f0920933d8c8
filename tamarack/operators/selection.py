"""Rows by their rank in the order of an integer key, without a sort and without a copy of the table.

Keys are counted by their leading bits; where a rank falls, the next bits are counted, until the key is known.  A pass
reads one column and shuffles partial counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.staging import Stage

RADIX_BITS = 10  # bits that a pass settles


def keys_at_ranks(df: DataFrame, key: str, ranks: DataFrame) -> DataFrame:
    """(rank, key) for rows (rank) of distinct ranks 0, 1, ... in the ascending order of an integer column without nulls.

    Equal keys take as many ranks as there are rows.  Ranks beyond the last row drop out.
    """
    value = F.col(key).cast("long")
    low, high = df.agg(F.min(value), F.max(value)).first()
    shift = 0
    # Arithmetic shifts keep the order of negative keys.
    while low is not None and (high >> shift) - (low >> shift) >= 1 << RADIX_BITS:
        shift += RADIX_BITS
    rank = F.col("rank").cast("long")
    state, kept = ranks.select(rank.alias("rank"), F.lit(0).cast("long").alias("above"), rank.alias("left")), None
    top = True
    while True:
        above = F.lit(0).cast("long") if top else F.shiftright(value, shift + RADIX_BITS)
        cells = df.select(above.alias("above"), F.shiftright(value, shift).alias("cell"))
        if not top:
            cells = cells.join(state.select("above").distinct(), "above", "left_semi")
        counts = cells.groupBy("above", "cell").agg(F.count("*").alias("n"))
        # At most 2^RADIX_BITS rows in a window.
        before = F.sum("n").over(Window.partitionBy("above").orderBy("cell")) - F.col("n")
        counts = counts.withColumn("before", before)
        inside = (F.col("left") >= F.col("before")) & (F.col("left") < F.col("before") + F.col("n"))
        found = state.join(counts, "above").filter(inside)
        narrowed = Stage(found.select("rank", F.col("cell").alias("above"), (F.col("left") - F.col("before")).alias("left")), "ranks")
        if kept is not None:
            kept.drop()
        state, kept, top = narrowed.df, narrowed, False
        if shift == 0:
            return state.select("rank", F.col("above").alias(key))
        shift -= RADIX_BITS


def key_at_rank(df: DataFrame, key: str, rank: int) -> int | None:
    """The key of one rank, None beyond the last row."""
    one = df.sparkSession.range(rank, rank + 1).select(F.col("id").alias("rank"))
    found = keys_at_ranks(df, key, one).first()
    return None if found is None else found[1]
