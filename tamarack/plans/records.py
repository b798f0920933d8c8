"""Delimited records: parsing, sums by key, top keys.

Line items are written out as 11-field text records.  Some do not parse, depending on their own
columns: returned items carry no amount, open items of the fourth line have a day-first date, and
items of the seventh line have a twelfth field.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators.relational import top_rows
from tamarack.plans.registry import registry
from tamarack.sources.keyed import look_up, write_keyed
from tamarack.sources.lines import dropped_records, keyed_records, pair_records, read_lines, read_numbered_lines, timed_records
from tamarack.sources.sinks import write_pairs
from tamarack.sources.tables import table
from tamarack.staging import checkpoint_root, spread

QUERIES, ORACLES, register = registry()


def record_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = spread(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    odd_date = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 4)
    when = F.when(odd_date, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )
    amount = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    extra = F.when(F.col("l_linenumber") == 7, F.lit("x"))
    fields = [
        F.col("l_orderkey"),
        F.concat(F.lit("S"), F.col("l_suppkey")),
        F.col("l_partkey"),
        when,
        F.col("l_linenumber"),
        F.col("l_quantity"),
        F.col("l_discount"),
        F.col("l_tax"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        amount,
        extra,
    ]
    return li.select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))


_GOOD_AMOUNT = "l_linenumber <> 7 AND l_returnflag <> 'R'"
_GOOD_DATE = "NOT (l_linestatus = 'O' AND l_linenumber = 4)"


@register(
    "daily_revenue",
    f"""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, ROUND(SUM(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE {_GOOD_AMOUNT} AND {_GOOD_DATE}
    GROUP BY 1
    """,
)
def daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return timed_records(record_lines(spark, sf)).groupBy(day).agg(F.round(F.sum("amount"), 2).alias("revenue"))


@register(
    "revenue_by_key",
    f"""
    SELECT 'S' || l_suppkey AS key, ROUND(SUM(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE {_GOOD_AMOUNT}
    GROUP BY 1
    """,
)
def revenue_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_records(record_lines(spark, sf)).groupBy("key").agg(F.round(F.sum("amount"), 2).alias("revenue"))


@register(
    "top5_revenue",
    f"""
    SELECT * FROM (
        SELECT 'S' || l_suppkey AS key, ROUND(SUM(l_extendedprice), 2) AS revenue
        FROM lineitem WHERE {_GOOD_AMOUNT}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
    ) ORDER BY revenue, key DESC
    """,
)
def top5_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Five strongest keys, weakest first."""
    best = top_rows(revenue_by_key(spark, sf), [F.col("revenue").desc(), F.col("key")], 5)
    return best.orderBy("revenue", F.col("key").desc())


@register(
    "dropped_records",
    f"""
    SELECT CASE WHEN l_linenumber = 7 THEN 'field_count'
                WHEN NOT ({_GOOD_DATE}) THEN 'time'
                WHEN l_returnflag = 'R' THEN 'amount' ELSE 'kept' END AS outcome,
           COUNT(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def dropped(spark: SparkSession, sf: str) -> DataFrame:
    return dropped_records(record_lines(spark, sf))


@register(
    "written_pairs",
    f"""
    SELECT 'S' || l_suppkey AS key, ROUND(SUM(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE {_GOOD_AMOUNT}
    GROUP BY 1
    """,
)
def written_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Sums by key written as tab-separated files in the shared folder, and read back as pairs."""
    path = f"{checkpoint_root(spark)}/pairs-{uuid.uuid4().hex}"
    write_pairs(revenue_by_key(spark, sf), path, key="key", value="revenue", files=8)
    return pair_records(read_lines(spark, path)).select("key", F.col("amount").alias("revenue"))


@register(
    "keyed_lookup",
    f"""
    SELECT 'S' || l_suppkey AS key, ROUND(SUM(l_extendedprice), 2) AS revenue
    FROM lineitem WHERE l_suppkey = 7 AND {_GOOD_AMOUNT}
    GROUP BY 1
    """,
)
def keyed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One key of the sums by key, from a table written for look-ups."""
    path = f"{checkpoint_root(spark)}/keyed-{uuid.uuid4().hex}"
    write_keyed(revenue_by_key(spark, sf), path, key="key", buckets=16)
    return look_up(spark, path, key="key", value="S7", buckets=16)


@register(
    "numbered_lines",
    """
    SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS row_id, CAST(c_custkey AS VARCHAR) || ',' || c_mktsegment AS value FROM customer
    """,
)
def numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written in order as lines of many files, and numbered as they lie in them."""
    path = f"{checkpoint_root(spark)}/lines-{uuid.uuid4().hex}"
    customers = table(spark, sf, "customer").repartitionByRange(12, "c_custkey").sortWithinPartitions("c_custkey")
    customers.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment").alias("value")).write.text(path)
    return read_numbered_lines(spark, path)


@register(
    "pair_records",
    """
    SELECT c_mktsegment AS key, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS amount
    FROM customer WHERE NOT contains(c_mktsegment, ' ') GROUP BY 1
    """,
)
def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated pairs, as one job leaves them for the next."""
    customers = table(spark, sf, "customer")
    lines = customers.select(F.concat_ws("\t", "c_mktsegment", F.col("c_acctbal").cast("string")).alias("value"))
    return pair_records(lines).groupBy("key").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))
