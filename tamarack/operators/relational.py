"""Relational operators: semi and anti joins, division, coverage, arg-max with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.staging import written


def distinct_where(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """Distinct projection of the rows that satisfy a condition."""
    return df.filter(condition).select(*columns).distinct()


def keys_meeting_all(df: DataFrame, keys: list[str], conditions: list[Column]) -> DataFrame:
    """Keys that have, for each condition, at least one row satisfying it.

    The self semi-join on ``keys`` as one partially aggregated pass: a hot key shrinks to one row
    per task before the shuffle.  NULL keys match nothing.
    """
    # The plain disjunction is what reaches the scan as a pushed filter.
    any_met = conditions[0]
    for c in conditions[1:]:
        any_met = any_met | c
    grouped = (
        df.filter(any_met)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(f"_has{i}") for i, c in enumerate(conditions)])
    )
    for i in range(len(conditions)):
        grouped = grouped.filter(F.col(f"_has{i}"))
    return grouped.select(*keys)


def exists_in(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` with a partner in ``other``; no fan-out."""
    return df.join(other.select(*on).distinct(), on, "left_semi")


def not_exists_in(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other``."""
    return df.join(other.select(*on).distinct(), on, "left_anti")


def never_linked(facts: DataFrame, excluded: DataFrame, *, who: str, link: str) -> DataFrame:
    """Distinct ``who`` of the facts that never touch a ``link`` of ``excluded``."""
    touched = facts.select(who, link).join(excluded.select(link).distinct(), link, "left_semi")
    return facts.select(who).distinct().join(touched.select(who).distinct(), who, "left_anti")


def frequent_groups(df: DataFrame, by: list[str], counted: str, *, more_than: int) -> DataFrame:
    """Groups whose count of non-null ``counted`` exceeds a bound."""
    return df.groupBy(*by).agg(F.count(counted).alias("n")).filter(F.col("n") > more_than)


def argmax_with_ties(df: DataFrame, value: str) -> DataFrame:
    """All rows that hold the maximum of ``value``."""
    return df.filter(F.col(value) == df.agg(F.max(value)).scalar())


def arg_max_per_group(df: DataFrame, by: str, choice: str, value: str) -> DataFrame:
    """(by, choice, value) with the largest value per group; the smallest choice wins a tie."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(choice).alias("c"))).alias("_b")
    return df.groupBy(by).agg(best).select(by, F.col("_b.c").alias(choice), (-F.col("_b.v")).alias(value))


def count_by_class(classes: DataFrame, facts: DataFrame, *, by: str, link: str, counted: str) -> DataFrame:
    """Facts per class through a link table, with 0 for a class that has none.

    A fact counts once per class however often the class lists its link.  A NULL class matches
    nothing.  Facts are reduced to one row per link before the join.
    """
    per_link = facts.groupBy(link).agg(F.count(counted).alias("_n"))
    links = classes.select(by, F.when(F.col(by).isNotNull(), F.col(link)).alias(link)).distinct()
    return links.join(per_link, link, "left").groupBy(by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def coverage_ratio(df: DataFrame, *, by: str, item: str, ratio: str = "ratio") -> DataFrame:
    """Distinct items of a group divided by all distinct items; a NULL group covers nothing.

    The distinct pairs are written, so that both counts come from them and the facts are read once.
    """
    pairs = written(df.select(by, item).distinct(), "coverage")
    total = pairs.agg(F.countDistinct(item).cast("double")).scalar()
    seen = F.when(F.col(by).isNull(), F.lit(0)).otherwise(F.col("_n"))
    return pairs.groupBy(by).agg(F.count(item).alias("_n")).select(by, F.try_divide(seen.cast("double"), total).alias(ratio))


def divide(
    dividend: DataFrame, divisor: DataFrame, *, who: str, key: str, empty_divisor: str = "none"
) -> DataFrame:
    """``who`` related to every key of the divisor (relational division).

    With no keys in the divisor the answer is nobody (``empty_divisor='none'``) or everybody
    (``'all'``).
    """
    if empty_divisor not in ("none", "all"):
        raise ValueError("empty_divisor is 'none' or 'all'")
    needed = divisor.select(key).dropna().distinct()
    total = needed.agg(F.count(key)).scalar()
    met = (
        dividend.select(who, key)
        .dropna()
        .distinct()
        .join(needed, key, "left_semi")
        .groupBy(who)
        .agg(F.count(key).alias("_n"))
    )
    if empty_divisor == "none":
        return met.filter(F.col("_n") == total).select(who)
    everyone = dividend.select(who).distinct().join(met, who, "left")
    return everyone.filter(F.coalesce(F.col("_n"), F.lit(0)) == total).select(who)


def completion(df: DataFrame, *, who: str, item: str, when: str, completed: str = "completed") -> DataFrame:
    """(who, last first-time) of those who have met every item that occurs in ``df``.

    First times are written, so that the number of items comes from them and ``df`` is read once.
    """
    firsts = written(df.groupBy(who, item).agg(F.min(when).alias("_first")), "first-times")
    total = firsts.agg(F.countDistinct(item)).scalar()
    done = firsts.dropna(subset=[who]).groupBy(who).agg(F.count(item).alias("_n"), F.max("_first").alias(completed))
    return done.filter(F.col("_n") == total).select(who, completed)


def first_dates(df: DataFrame, *, by: list[str], when: str, first: str = "first") -> DataFrame:
    return df.groupBy(*by).agg(F.min(when).alias(first))


def absolute_change(new: DataFrame, old: DataFrame, *, key: str, value: str) -> DataFrame:
    """One row: the sum of absolute differences between two versions of a table."""
    pairs = new.select(key, F.col(value).alias("_a")).join(old.select(key, F.col(value).alias("_b")), key)
    return pairs.agg(F.sum(F.abs(F.col("_a") - F.col("_b"))).alias("change"))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order: local top-n per task, then one merge of those."""
    return df.orderBy(*order).limit(n)
