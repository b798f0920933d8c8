"""Sums over the axes of a sparse (doc, topic, word, n) count cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.relational import arg_max_per_group


def slice_total(cube: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row: the sum over a slice of the cube; 0 when the slice is empty."""
    part = cube if condition is None else cube.filter(condition)
    return part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def axis_totals(cube: DataFrame, axis: str, condition: Column | None = None) -> DataFrame:
    """Sum per value of one axis."""
    part = cube if condition is None else cube.filter(condition)
    return part.groupBy(axis).agg(F.sum("n").alias("n"))


def axis_vector(cube: DataFrame, axis: str, condition: Column, members: DataFrame) -> DataFrame:
    """Sum per value of one axis within a slice, with 0 for the members the slice lacks."""
    inside = axis_totals(cube, axis, condition)
    return members.join(inside, axis, "left").select(axis, F.coalesce("n", F.lit(0)).alias("n"))


def leading_topic(cube: DataFrame, *, topic: str = "topic", word: str = "word") -> DataFrame:
    """(word, topic, n): the topic with the largest count per word, the smallest one on a tie."""
    sums = cube.groupBy(word, topic).agg(F.sum("n").alias("n"))
    return arg_max_per_group(sums, word, topic, "n")
