"""Numeric expressions that stay finite."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def softplus(t: Column) -> Column:
    """ln(1 + e^t) without overflow."""
    return F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t)))


def sigmoid(t: Column) -> Column:
    """1 / (1 + e^-t) without overflow."""
    e = F.exp(-F.abs(t))
    return F.when(t >= 0, F.lit(1.0) / (F.lit(1.0) + e)).otherwise(e / (F.lit(1.0) + e))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0 where it is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def clip01(n: Column) -> Column:
    return F.greatest(F.least(n, F.lit(1)), F.lit(0))


def binomial_log_odds(p1: float, p2: float) -> tuple[float, float]:
    """ln(p1/p2) per head and ln((1-p1)/(1-p2)) per tail; the binomial coefficient cancels."""
    floor = 1e-300
    heads = math.log(max(p1, floor)) - math.log(max(p2, floor))
    tails = math.log(max(1.0 - p1, floor)) - math.log(max(1.0 - p2, floor))
    return heads, tails


def hinge(label: Column, score: Column) -> Column:
    """max(0, 1 - y * score)."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - label * score)
