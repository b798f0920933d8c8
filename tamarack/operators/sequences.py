"""Labelled character sequences from per-class line corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import char_codes, is_blank, pad_left
from tamarack.operators.sampling import sample_exact


def char_sequences(
    lines: DataFrame, *, ids: list[str], label: str = "label", line: str = "line", per_class: int = 11_000, seed: int
) -> DataFrame:
    """(label, ids, sample_order, line, codes): sampled lines per class as character codes.

    The sample is drawn first and its blank lines are dropped after; codes of 256 and above go.
    """
    sampled = sample_exact(lines.select(label, *ids, line), n=per_class, ids=ids, seed=seed, by=label)
    return sampled.filter(~is_blank(F.col(line))).withColumn("codes", char_codes(F.col(line)))


def padded_sequences(sequences: DataFrame, *, line: str = "line") -> DataFrame:
    """Add ``padded``: codes left-padded with -1 to the longest sampled line.

    The length is that of the raw line, before codes are dropped and without its line end.
    """
    longest = sequences.agg(F.max(F.length(line))).scalar()
    return sequences.withColumn("padded", pad_left(F.col("codes"), longest))
