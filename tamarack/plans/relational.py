"""The relational suite on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.text import month_name
from tamarack.operators import relational as rel
from tamarack.operators.ordering import global_index, range_totals, sliding_windows
from tamarack.plans.registry import registry
from tamarack.sources.tables import table

QUERIES, ORACLES, register = registry()


@register("distinct_filter", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def distinct_filter(spark: SparkSession, sf: str) -> DataFrame:
    return rel.distinct_where(table(spark, sf, "lineitem"), F.col("l_returnflag") == "R", "l_suppkey")


@register(
    "self_semi_join",
    """
    WITH seen AS (
        SELECT o_custkey, o_orderpriority, bool_or(o_orderstatus = 'F') AS finished, bool_or(o_orderstatus = 'P') AS pending
        FROM orders GROUP BY ALL)
    SELECT DISTINCT o_custkey FROM seen WHERE finished AND pending
    """,
)
def self_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a finished and a pending order of the same priority."""
    status = F.col("o_orderstatus")
    both = rel.keys_meeting_all(
        table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], [status == "F", status == "P"]
    )
    return both.select("o_custkey").distinct()


@register(
    "concat_semi",
    """
    SELECT DISTINCT concat_ws(' ', p_brand, p_type) AS full_name
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE o_totalprice > 499000 AND l_returnflag IN ('A', 'R')
    """,
)
def concat_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Names of parts in returned or accepted lines of large orders."""
    large = table(spark, sf, "orders").filter("o_totalprice > 499000").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem").filter("l_returnflag = 'R' OR l_returnflag = 'A'")
    sold = lines.select("l_orderkey", "l_partkey").join(large, "l_orderkey", "left_semi")
    parts = rel.exists_in(table(spark, sf, "part"), sold.select(F.col("l_partkey").alias("p_partkey")), ["p_partkey"])
    return parts.select(F.concat("p_brand", F.lit(" "), "p_type").alias("full_name")).distinct()


@register(
    "month_filter_join",
    """
    SELECT DISTINCT c.c_mktsegment, n.n_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P' AND strftime(o.o_orderdate, '%B') = 'August'
    """,
)
def month_filter_join(spark: SparkSession, sf: str) -> DataFrame:
    august = table(spark, sf, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P") & (month_name(F.col("o_orderdate")) == "August")
    )
    buyers = rel.exists_in(
        table(spark, sf, "customer"), august.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]
    )
    placed = buyers.select("c_mktsegment", "c_nationkey").distinct()
    nation = table(spark, sf, "nation")
    return placed.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "n_name").distinct()


@register(
    "group_having",
    "SELECT p_brand, CAST(p_size AS BIGINT) AS p_size, COUNT(p_type) AS n FROM part GROUP BY 1, 2 HAVING COUNT(p_type) > 2",
)
def group_having(spark: SparkSession, sf: str) -> DataFrame:
    groups = rel.frequent_groups(table(spark, sf, "part"), ["p_brand", "p_size"], "p_type", more_than=2)
    return groups.select("p_brand", F.col("p_size").cast("long").alias("p_size"), "n")


@register(
    "argmax_ties",
    """
    WITH c AS (SELECT p_brand, p_size, COUNT(*) AS n FROM part GROUP BY 1, 2)
    SELECT p_brand, CAST(p_size AS BIGINT) AS p_size, n FROM c WHERE n = (SELECT MAX(n) FROM c)
    """,
)
def argmax_ties(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "part").groupBy("p_brand", F.col("p_size").cast("long").alias("p_size")).agg(F.count("*").alias("n"))
    return rel.argmax_with_ties(counts, "n")


@register(
    "busiest_supplier",
    """
    WITH c AS (SELECT l_suppkey, COUNT(l_partkey) AS n FROM lineitem GROUP BY 1)
    SELECT l_suppkey, n FROM c WHERE n = (SELECT MAX(n) FROM c)
    """,
)
def busiest_supplier(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("l_partkey").alias("n"))
    return rel.argmax_with_ties(counts, "n")


@register(
    "nested_anti",
    """
    WITH flagged AS (
        SELECT l_orderkey, max(CASE WHEN l_discount = 0.1 AND l_quantity > 45 THEN 1 ELSE 0 END) AS deep
        FROM lineitem GROUP BY l_orderkey)
    SELECT o_custkey FROM orders LEFT JOIN flagged ON l_orderkey = o_orderkey
    GROUP BY o_custkey HAVING sum(coalesce(deep, 0)) = 0
    """,
)
def nested_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Customers none of whose orders has a large, deeply discounted line."""
    deep = table(spark, sf, "lineitem").filter("l_discount = 0.1 AND l_quantity > 45")
    return rel.never_linked(
        table(spark, sf, "orders"), deep.select(F.col("l_orderkey").alias("o_orderkey")), who="o_custkey", link="o_orderkey"
    )


@register(
    "count_with_zero",
    """
    SELECT p_name, count(l_suppkey) AS n
    FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_name
    """,
)
def count_with_zero(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per part name, 0 for a name without any."""
    facts = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return rel.count_by_class(table(spark, sf, "part"), facts, by="p_name", link="p_partkey", counted="l_suppkey")


@register(
    "coverage_ratio",
    """
    WITH kinds AS (SELECT DISTINCT l_partkey FROM lineitem)
    SELECT strftime(l_shipdate, '%B') AS month_name,
           CAST(COUNT(DISTINCT l_partkey) AS DOUBLE) / (SELECT COUNT(*) FROM kinds) AS ratio
    FROM lineitem GROUP BY 1
    """,
)
def coverage_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Share of all sold parts that each calendar month ships, years together."""
    shipped = table(spark, sf, "lineitem").select(month_name(F.col("l_shipdate")).alias("month_name"), "l_partkey")
    return rel.coverage_ratio(shipped, by="month_name", item="l_partkey")


_BOUGHT = """
    bought AS (
        SELECT DISTINCT o.o_custkey, p.p_brand
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey)
"""


def _purchases(spark: SparkSession, sf: str) -> DataFrame:
    """(o_custkey, p_brand, l_shipdate) per line item."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(part, "l_partkey").join(orders, "l_orderkey").select("o_custkey", "p_brand", "l_shipdate")


@register(
    "relational_division",
    f"""
    WITH {_BOUGHT},
    wanted AS (SELECT p_brand FROM part WHERE p_brand <> 'Brand#1' AND p_size > 5 GROUP BY p_brand)
    SELECT o_custkey FROM bought JOIN wanted USING (p_brand)
    GROUP BY o_custkey HAVING count(DISTINCT p_brand) = (SELECT count(*) FROM wanted)
    """,
)
def relational_division(spark: SparkSession, sf: str) -> DataFrame:
    """Customers who bought every brand but one."""
    wanted = table(spark, sf, "part").filter((F.col("p_brand") != "Brand#1") & (F.col("p_size") > 5))
    return rel.divide(_purchases(spark, sf), wanted, who="o_custkey", key="p_brand")


@register(
    "relational_division_empty",
    f"""
    WITH {_BOUGHT},
    wanted AS (SELECT p_brand AS brand FROM part WHERE p_size > 1000 GROUP BY p_brand)
    SELECT o_custkey FROM bought LEFT JOIN wanted ON brand = p_brand
    GROUP BY o_custkey HAVING count(DISTINCT brand) = (SELECT count(*) FROM wanted)
    """,
)
def relational_division_empty(spark: SparkSession, sf: str) -> DataFrame:
    """An empty divisor under the rule that everybody has nothing."""
    wanted = table(spark, sf, "part").filter("p_size > 1000")
    return rel.divide(_purchases(spark, sf), wanted, who="o_custkey", key="p_brand", empty_divisor="all")


@register(
    "completion_date",
    """
    WITH firsts AS (
        SELECT l.l_suppkey, p.p_brand, MIN(l.l_shipdate) AS d
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2)
    SELECT l_suppkey, strftime(MAX(d), '%Y-%m-%d') AS completed
    FROM firsts GROUP BY 1
    HAVING COUNT(p_brand) = (SELECT COUNT(DISTINCT p_brand) FROM firsts)
    """,
)
def completion_date(spark: SparkSession, sf: str) -> DataFrame:
    """Day on which each supplier had first shipped every brand."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    done = rel.completion(li.join(part, "l_partkey"), who="l_suppkey", item="p_brand", when="l_shipdate")
    return done.select("l_suppkey", F.date_format("completed", "yyyy-MM-dd").alias("completed"))


@register(
    "first_dates",
    "SELECT l_suppkey, l_returnflag, strftime(MIN(l_shipdate), '%Y-%m-%d') AS first FROM lineitem GROUP BY 1, 2",
)
def first_dates(spark: SparkSession, sf: str) -> DataFrame:
    firsts = rel.first_dates(table(spark, sf, "lineitem"), by=["l_suppkey", "l_returnflag"], when="l_shipdate")
    return firsts.withColumn("first", F.date_format("first", "yyyy-MM-dd"))


def _lines_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_shipdate").agg(F.count("l_partkey").alias("n"))


_WINDOWS = """
    days AS (SELECT l_shipdate AS d, count(l_partkey) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY l_shipdate),
    totals AS (
        SELECT d AS upper_d, first_value(d) OVER run AS lower_d, CAST(sum(n) OVER run AS BIGINT) AS n
        FROM days WINDOW run AS (ORDER BY d ROWS 19 PRECEDING) QUALIFY count(*) OVER run = 20)
"""


@register(
    "best_sequence_window",
    f"""
    WITH {_WINDOWS}
    SELECT strftime(upper_d, '%Y-%m-%d') AS upper_day, strftime(lower_d, '%Y-%m-%d') AS lower_day, n
    FROM totals WHERE n = (SELECT MAX(n) FROM totals)
    """,
)
def best_sequence_window(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 consecutive ship days with the most lines, all ties."""
    runs = sliding_windows(_lines_per_day(spark, sf), key="l_shipdate", value="n", width=20)
    best = rel.argmax_with_ties(runs.withColumnRenamed("total", "n"), "n")
    return best.select(
        F.date_format("first_key", "yyyy-MM-dd").alias("upper_day"), F.date_format("last_key", "yyyy-MM-dd").alias("lower_day"), "n"
    )


@register(
    "sequence_windows",
    f"""
    WITH {_WINDOWS}
    SELECT strftime(upper_d, '%Y-%m-%d') AS upper_day, strftime(lower_d, '%Y-%m-%d') AS lower_day, n FROM totals
    """,
)
def sequence_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every run of 20 consecutive ship days with its number of lines."""
    runs = sliding_windows(_lines_per_day(spark, sf), key="l_shipdate", value="n", width=20)
    return runs.select(
        F.date_format("first_key", "yyyy-MM-dd").alias("upper_day"),
        F.date_format("last_key", "yyyy-MM-dd").alias("lower_day"),
        F.col("total").alias("n"),
    )


@register(
    "global_row_number",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders",
)
def global_row_number(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ranked = global_index(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], index="place")
    return ranked.select("o_orderkey", (F.col("place") + 1).alias("place"))


@register(
    "range_totals",
    """
    SELECT s.s_suppkey, CAST(SUM(o.n) AS BIGINT) AS n
    FROM supplier s LEFT JOIN (SELECT o_totalprice, COUNT(*) AS n FROM orders GROUP BY 1) o
      ON o.o_totalprice >= s.s_acctbal * 40 AND o.o_totalprice <= s.s_acctbal * 41
    GROUP BY 1
    """,
)
def range_totals_query(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose price lies in a band set by each supplier; NULL where there is none."""
    balance = F.col("s_acctbal")
    bands = table(spark, sf, "supplier").select("s_suppkey", (balance * 40).alias("low"), (balance * 41).alias("high"))
    prices = table(spark, sf, "orders").groupBy("o_totalprice").agg(F.count("*").alias("n"))
    return range_totals(bands, prices, low="low", high="high", at="o_totalprice", value="n", total="n").select("s_suppkey", "n")


@register(
    "range_sums",
    """
    SELECT s.s_suppkey, ROUND(SUM(o.o_totalprice), 2) AS total
    FROM supplier s LEFT JOIN orders o ON o.o_totalprice BETWEEN s.s_acctbal * 40 AND s.s_acctbal * 41
    GROUP BY 1
    """,
)
def range_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Worth of the orders in each supplier's band; NULL where there is none."""
    balance = F.col("s_acctbal")
    bands = table(spark, sf, "supplier").select("s_suppkey", (balance * 40).alias("low"), (balance * 41).alias("high"))
    worth = table(spark, sf, "orders").select("o_totalprice", F.col("o_totalprice").alias("worth"))
    found = range_totals(bands, worth, low="low", high="high", at="o_totalprice", value="worth")
    return found.select("s_suppkey", F.round("total", 2).alias("total"))


@register(
    "absolute_change",
    """
    WITH v AS (
        SELECT c.c_nationkey AS k, year(o.o_orderdate) AS y, SUM(o.o_totalprice) AS t
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)
    SELECT ROUND(SUM(ABS(a.t - b.t)), 2) AS change FROM v a JOIN v b ON a.k = b.k AND a.y = 1998 AND b.y = 1997
    """,
)
def absolute_change(spark: SparkSession, sf: str) -> DataFrame:
    """Total movement of the nations' order values between two years."""
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k"))
    yearly = orders.filter("y IN (1997, 1998)").groupBy("o_custkey", "y").agg(F.sum("o_totalprice").alias("t"))
    by_nation = yearly.join(customers, "o_custkey").groupBy("k", "y").agg(F.sum("t").alias("t"))
    new, old = by_nation.filter("y = 1998"), by_nation.filter("y = 1997")
    return rel.absolute_change(new, old, key="k", value="t").select(F.round("change", 2).alias("change"))


@register(
    "top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rel.top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register(
    "largest_keys",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey DESC LIMIT 10",
)
def largest_keys(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    return rel.top_rows(done, [F.col("o_orderkey").desc()], 10)


@register(
    "leading_choice",
    """
    SELECT l_suppkey, l_returnflag, n FROM (
        SELECT l_suppkey, l_returnflag, COUNT(*) AS n,
               ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC, l_returnflag) AS r
        FROM lineitem GROUP BY 1, 2) WHERE r = 1
    """,
)
def leading_choice(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    return rel.arg_max_per_group(counts, "l_suppkey", "l_returnflag", "n")
