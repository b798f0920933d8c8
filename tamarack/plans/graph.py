"""Graph queries.

Conversation graph: a turn cites the turn before it (paths).  Trade graph: parts cite the suppliers
that ship them, suppliers their nation, nations their suppliers and region; regions cite nothing.
Key ranges overlap between tables, so each kind gets an offset far above its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.operators import graph
from tamarack.plans.registry import registry
from tamarack.sources.tables import table

QUERIES, ORACLES, register = registry()

# Offsets that keep the key ranges of the graph's kinds apart.
TURN_SPAN = 1 << 20
KIND = 10**12

_TALK = f"""
    nodes AS (SELECT conv_id * {TURN_SPAN} + turn AS id, role AS title FROM conversations),
    edges AS (
        SELECT conv_id * {TURN_SPAN} + turn AS src, conv_id * {TURN_SPAN} + turn - 1 AS dst
        FROM conversations WHERE turn > 0)
"""

_PLACES = f"""
    nodes AS (
        SELECT {KIND} + s_suppkey AS id, s_name AS title FROM supplier
        UNION ALL SELECT 2 * {KIND} + n_nationkey, n_name FROM nation
        UNION ALL SELECT 3 * {KIND} + r_regionkey, r_name FROM region),
    edges AS (
        SELECT {KIND} + s_suppkey AS src, 2 * {KIND} + s_nationkey AS dst FROM supplier
        UNION ALL SELECT 2 * {KIND} + n_nationkey, 3 * {KIND} + n_regionkey FROM nation)
"""

_TRADE = f"""
    nodes AS MATERIALIZED (
        SELECT p_partkey AS id, p_name AS title FROM part
        UNION ALL SELECT {KIND} + s_suppkey, s_name FROM supplier
        UNION ALL SELECT 2 * {KIND} + n_nationkey, n_name FROM nation
        UNION ALL SELECT 3 * {KIND} + r_regionkey, r_name FROM region),
    edges AS MATERIALIZED (
        SELECT l_partkey AS src, {KIND} + l_suppkey AS dst FROM lineitem
        UNION ALL SELECT {KIND} + s_suppkey, 2 * {KIND} + s_nationkey FROM supplier
        UNION ALL SELECT 2 * {KIND} + s_nationkey, {KIND} + s_suppkey FROM supplier
        UNION ALL SELECT 2 * {KIND} + n_nationkey, 3 * {KIND} + n_regionkey FROM nation)
"""

_COMPONENTS = """
    both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
    reach(id, other) AS (
        SELECT id, id FROM nodes UNION SELECT r.id, b.dst FROM reach r JOIN both_ways b ON b.src = r.other),
    labels AS (SELECT id, MIN(other) AS component FROM reach GROUP BY 1)
"""


def talk_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    turns = table(spark, sf, "conversations")
    own = F.col("conv_id") * TURN_SPAN + F.col("turn")
    nodes = turns.select(own.alias("id"), F.col("role").alias("title"))
    edges = turns.filter("turn > 0").select(own.alias("src"), (own - 1).alias("dst"))
    return nodes, edges


def _kind(number: int, key: str):
    return F.lit(number * KIND) + F.col(key).cast("long")


def place_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    nodes = (
        supplier.select(_kind(1, "s_suppkey").alias("id"), F.col("s_name").alias("title"))
        .unionByName(nation.select(_kind(2, "n_nationkey").alias("id"), F.col("n_name").alias("title")))
        .unionByName(region.select(_kind(3, "r_regionkey").alias("id"), F.col("r_name").alias("title")))
    )
    edges = supplier.select(_kind(1, "s_suppkey").alias("src"), _kind(2, "s_nationkey").alias("dst")).unionByName(
        nation.select(_kind(2, "n_nationkey").alias("src"), _kind(3, "n_regionkey").alias("dst"))
    )
    return nodes, edges


def trade_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    nodes, edges = place_graph(spark, sf)
    part, lines, supplier = (table(spark, sf, t) for t in ("part", "lineitem", "supplier"))
    nodes = nodes.unionByName(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title")))
    shipped = lines.select(F.col("l_partkey").alias("src"), _kind(1, "l_suppkey").alias("dst"))
    back = supplier.select(_kind(2, "s_nationkey").alias("src"), _kind(1, "s_suppkey").alias("dst"))
    return nodes, edges.unionByName(shipped).unionByName(back)


@register("components", f"WITH RECURSIVE {_TALK}, {_COMPONENTS} SELECT id, component FROM labels")
def components(spark: SparkSession, sf: str) -> DataFrame:
    return graph.connected_components(*talk_graph(spark, sf))


@register("components_star", f"WITH RECURSIVE {_PLACES}, {_COMPONENTS} SELECT id, component FROM labels")
def components_star(spark: SparkSession, sf: str) -> DataFrame:
    """The region trees: hubs with many neighbours."""
    return graph.connected_components(*place_graph(spark, sf))


@register(
    "component_size_band",
    f"""
    WITH RECURSIVE {_TALK}, {_COMPONENTS},
    sizes AS (SELECT component, COUNT(*) AS size FROM labels GROUP BY 1 HAVING COUNT(*) > 4 AND COUNT(*) <= 10)
    SELECT n.id, n.title, l.component, s.size
    FROM nodes n JOIN labels l ON l.id = n.id JOIN sizes s ON s.component = l.component
    """,
)
def component_size_band(spark: SparkSession, sf: str) -> DataFrame:
    return graph.components_of_size(*talk_graph(spark, sf))


@register(
    "reachable",
    f"""
    WITH RECURSIVE {_PLACES},
    both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
    reach(id) AS (SELECT MIN(id) FROM nodes UNION SELECT b.dst FROM reach r JOIN both_ways b ON b.src = r.id)
    SELECT id FROM reach
    """,
)
def reachable(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = place_graph(spark, sf)
    return graph.reachable(nodes, edges, nodes.agg(F.min("id").alias("id")))


@register(
    "undirected_edges",
    f"WITH {_TRADE} SELECT src, dst FROM edges UNION SELECT dst, src FROM edges",
)
def undirected_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.undirected(trade_graph(spark, sf)[1])


@register(
    "out_degree",
    f"WITH {_TRADE} SELECT n.id, COUNT(e.dst) AS degree FROM nodes n LEFT JOIN edges e ON e.src = n.id GROUP BY 1",
)
def out_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.out_degree(*trade_graph(spark, sf))


@register(
    "never_cited",
    f"WITH {_TALK} SELECT id FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.dst = n.id)",
)
def never_cited(spark: SparkSession, sf: str) -> DataFrame:
    """Turns that nothing follows."""
    return graph.never_cited(*talk_graph(spark, sf))


PAGE_RANK_STEPS = 40


def _page_rank_sql(steps: int) -> str:
    """Unrolled iteration; the first version whose change is within the tolerance is the result."""
    parts = [
        _TRADE,
        "links AS MATERIALIZED (SELECT DISTINCT src, dst FROM edges)",
        "total AS (SELECT COUNT(*) AS n FROM nodes)",
        "degrees AS MATERIALIZED (SELECT n.id, COUNT(l.dst) AS degree FROM nodes n LEFT JOIN links l ON l.src = n.id GROUP BY 1)",
        "r0 AS MATERIALIZED (SELECT id, degree, 1.0::DOUBLE / (SELECT n FROM total) AS rank FROM degrees)",
    ]
    for i in range(1, steps + 1):
        p = f"r{i - 1}"
        parts.append(
            f"""r{i} AS MATERIALIZED (
            SELECT a.id, a.degree, 0.15::DOUBLE / (SELECT n FROM total) + 0.85::DOUBLE * (COALESCE(i.s, 0)
                + COALESCE((SELECT SUM(rank) FROM {p} WHERE degree = 0), 0) / ((SELECT n FROM total) - 1)) AS rank
            FROM {p} a LEFT JOIN (
                SELECT l.dst, SUM(b.rank / b.degree) AS s FROM links l JOIN {p} b ON b.id = l.src GROUP BY 1) i
            ON i.dst = a.id)"""
        )
    changes = " UNION ALL ".join(
        f"SELECT {i} AS step, (SELECT SUM(ABS(a.rank - b.rank)) FROM r{i} a JOIN r{i - 1} b ON a.id = b.id) AS change"
        for i in range(1, steps + 1)
    )
    parts.append(f"changes AS MATERIALIZED ({changes})")
    parts.append("halt AS (SELECT MIN(step) AS step FROM changes WHERE change <= 0.01)")
    chosen = " UNION ALL ".join(f"SELECT {i} AS step, id, rank FROM r{i}" for i in range(1, steps + 1))
    parts.append(f"ranks AS (SELECT id, rank FROM ({chosen}) WHERE step = (SELECT step FROM halt))")
    return "WITH " + ",\n".join(parts)


@register("pagerank", f"{_page_rank_sql(PAGE_RANK_STEPS)} SELECT id, ROUND(rank, 12) AS rank FROM ranks")
def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    ranks = graph.page_rank(*trade_graph(spark, sf))
    return ranks.select("id", F.round("rank", 12).alias("rank"))


@register(
    "pagerank_top10",
    f"""{_page_rank_sql(PAGE_RANK_STEPS)}
    SELECT n.id, n.title, ROUND(r.rank, 12) AS rank FROM ranks r JOIN nodes n ON n.id = r.id
    ORDER BY ROUND(r.rank, 12) DESC, n.id LIMIT 10
    """,
)
def pagerank_top10(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = trade_graph(spark, sf)
    return graph.top_ranked(graph.page_rank(nodes, edges), nodes, n=10, digits=12)
