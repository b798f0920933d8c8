"""Expressions over ARRAY<DOUBLE> columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a lambda is evaluated for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_doubles(a: Column) -> Column:
    return a.cast("array<double>")


def vsum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def dot(a: Column, b: Column) -> Column:
    return vsum(multiply(a, b))


def squared_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)


def norm(a: Column) -> Column:
    return F.sqrt(squared_norm(a))


def clip_vector(a: Column) -> Column:
    """Presence vector: entries above 1 become 1."""
    return F.transform(a, lambda x: F.least(x, F.lit(1.0)))


def standardise(a: Column) -> Column:
    """(x - mean) / std within one vector; population std, and 1 in its place when it is 0."""

    def scale(centred: Column) -> Column:
        std = F.sqrt(squared_norm(centred) / F.size(centred))
        safe = F.when(std == 0, F.lit(1.0)).otherwise(std)
        return bind(safe, lambda s: F.transform(centred, lambda x: x / s))

    mean = vsum(a) / F.size(a)
    centred = bind(mean, lambda m: F.transform(a, lambda x: x - m))
    return bind(centred, scale)


def _shifted_exp_sum(scores: Column, top: Column) -> Column:
    return F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s - top))


def log_softmax_at(scores: Column, label: Column) -> Column:
    """ln softmax(scores)[label], shifted by the maximum so that it cannot overflow."""
    return bind(
        F.array_max(scores),
        lambda top: F.get(scores, label) - top - F.log(_shifted_exp_sum(scores, top)),
    )


def softmax(scores: Column) -> Column:
    return bind(
        F.array_max(scores),
        lambda top: bind(
            _shifted_exp_sum(scores, top),
            lambda total: F.transform(scores, lambda s: F.exp(s - top) / total),
        ),
    )


def first_positive_argmax(scores: Column) -> Column:
    """Index of the first maximum; -1 when no score is above 0."""
    top = F.array_max(scores)
    return F.when(top > 0, F.array_position(scores, top) - 1).otherwise(F.lit(-1)).cast("long")
