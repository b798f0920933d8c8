"""Graph operators over nodes (id) and edges (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.staging import Stage, written


def undirected(edges: DataFrame) -> DataFrame:
    """The edges in both directions, each once."""
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def out_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree): edges per source, repeated edges counted, 0 for a node without any."""
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.count("dst").alias("_d"))
    return nodes.select("id").join(degrees, "id", "left").select("id", F.coalesce("_d", F.lit(0)).alias("degree"))


def never_cited(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that no edge points to."""
    return nodes.select("id").join(edges.select(F.col("dst").alias("id")).distinct(), "id", "left_anti")


def _least_around(edges: DataFrame) -> DataFrame:
    """(v, _m): the smallest neighbour of every id, over edges from a larger ``u`` to a smaller ``v``."""
    seen = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
    return seen.groupBy(F.col("e.u").alias("v")).agg(F.min("e.v").alias("_m"))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest member of its neighbourhood.

    Edges run from the larger id ``u`` to the smaller ``v``.  ``least`` is a written table: an aggregate inside
    the join's own plan would keep the adaptive join from splitting the edges of a hub.
    """
    return edges.join(least, "v").select("u", F.least("v", "_m").alias("v"))


def _small_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; ``least`` (u, _m) is a written table."""
    others = edges.join(least, "u").filter(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return least.select("u", F.col("_m").alias("v")).unionByName(others)


def _round(edges: DataFrame, sums: dict) -> Stage:
    """One large-star and one small-star step."""
    around = Stage(_least_around(edges), "least")
    large = Stage(_large_star(edges, around.df).distinct(), "large-stars")
    below = Stage(large.df.groupBy("u").agg(F.min("v").alias("_m")), "least")
    following = Stage(_small_star(large.df, below.df).distinct(), "stars", sums)
    for passed in (around, large, below):
        passed.drop()
    return following


def component_labels(edges: DataFrame, nodes: DataFrame | None = None, *, max_rounds: int = 100) -> DataFrame:
    """(id, component) of every id on an edge or among the nodes; the component is its smallest id.

    Alternates large-star and small-star until the edges are stars around their minima (Kiveris et
    al., SoCC 2014): a number of rounds that grows with the logarithm of the graph, not with its
    diameter.  Each round is written out, so a lost executor costs at most that round.
    """
    canonical = edges.filter(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    fingerprint = {"n": F.count("*"), "hash": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    stage = Stage(canonical.distinct(), "stars", fingerprint)
    for _ in range(max_rounds):
        if not stage.sums.get("n"):
            break
        following = _round(stage.df, fingerprint)
        settled = following.sums == stage.sums
        stage.drop()
        stage = following
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # A star's leaf is labelled by its centre; every other id by itself, which is never smaller.
    loops = edges.filter(F.col("src") == F.col("dst")).select(F.col("src").alias("id"))
    own = loops if nodes is None else loops.unionByName(nodes.select("id"))
    labelled = (
        stage.df.select(F.col("u").alias("id"), F.col("v").alias("component"))
        .unionByName(stage.df.select(F.col("v").alias("id"), F.col("v").alias("component")))
        .unionByName(own.select("id", F.col("id").alias("component")))
    )
    return labelled.groupBy("id").agg(F.min("component").alias("component"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of all nodes and of edge ends that are missing from the nodes."""
    return component_labels(edges, nodes)


def components_of_size(nodes: DataFrame, edges: DataFrame, *, above: int = 4, up_to: int = 10) -> DataFrame:
    """(id, title, component, size) of nodes in components with above < size <= up_to.

    The size counts ids that occur only on edges; they are not output.
    """
    labels = written(connected_components(nodes, edges), "labels")
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    # Written, so that the join with it may be split where one component holds most ids.
    fitting = written(sizes.filter((F.col("size") > above) & (F.col("size") <= up_to)), "fitting")
    return nodes.select("id", "title").join(labels.join(fitting, "component"), "id").select("id", "title", "component", "size")


def reachable(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, *, levels: int = 16) -> DataFrame:
    """Ids that can be reached, edges taken both ways, from any id in ``seeds``.

    Level by level: a level's neighbours lie in it, in the one before or in the next, so only the ids found last meet the
    edges, and they are held against two levels, not against all that was reached.  What is left after ``levels`` of them,
    as on long paths, is settled by components of the part that was not reached, in logarithmic rounds.
    """
    links = Stage(undirected(edges).filter(F.col("src") != F.col("dst")), "links").df
    known = nodes.select("id").unionByName(edges.select(F.col("src").alias("id"))).unionByName(edges.select(F.col("dst").alias("id")))
    count = {"n": F.count("*")}
    found = [Stage(seeds.select("id").distinct().join(known, "id", "left_semi"), "level", count)]
    while found[-1].sums.get("n") and len(found) <= levels:
        last = found[-1].df.select(F.col("id").alias("src"))
        near = links.join(last, "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        before = found[-1].df if len(found) == 1 else found[-1].df.unionByName(found[-2].df)
        found.append(Stage(near.join(before, "id", "left_anti"), "level", count))
    reached = found[0].df
    for level in found[1:]:
        reached = reached.unionByName(level.df)
    if not found[-1].sums.get("n"):
        return reached
    # Paths to what is left lead through ids of the last level and beyond only.
    open_links = links
    if len(found) > 1:
        inner = found[0].df
        for level in found[1:-1]:
            inner = inner.unionByName(level.df)
        inner = written(inner, "inner")
        for end in ("src", "dst"):
            open_links = open_links.join(inner.withColumnRenamed("id", end), end, "left_anti")
    labels = written(component_labels(open_links.select("src", "dst"), found[-1].df), "labels")
    home = written(labels.join(found[-1].df, "id", "left_semi").select("component").distinct(), "home")
    return reached.unionByName(labels.join(home, "component", "left_semi").select("id")).distinct()


def page_rank(
    nodes: DataFrame,
    edges: DataFrame,
    *,
    damping: float = 0.85,
    tolerance: float = 0.01,
    max_rounds: int = 1000,
    dedupe_edges: bool = True,
    hub: int = 100_000,
) -> DataFrame:
    """(id, rank, degree): ranks iterated until their total absolute change is within the tolerance.

    rank = (1 - damping)/N + damping * (sum over citing nodes of rank/degree + S/(N - 1)), where S is
    the rank held by nodes without outgoing edges.  A citing node counts once per cited node; with
    ``dedupe_edges=False`` its degree still counts repeated edges.

    Edges of a node with more than ``hub`` of them are spread over several join keys, and the
    edges are laid out by join key once; a round moves only ranks and partial sums.
    """
    spark = nodes.sparkSession
    distinct_edges = edges.select("src", "dst").distinct()
    degrees = out_degree(nodes, distinct_edges if dedupe_edges else edges)
    n = degrees.count()
    if n <= 1:
        return degrees.select("id", F.lit(1.0).alias("rank"), "degree")
    spread_of = F.greatest(F.ceil(F.col("degree") / hub), F.lit(1)).cast("int")
    watched = {
        "held": F.sum(F.when(F.col("degree") == 0, F.col("rank"))),
        "change": F.sum(F.abs(F.col("rank") - F.col("last"))),
    }
    state = Stage(
        degrees.select("id", "degree", spread_of.alias("parts"), F.lit(1.0 / n).alias("rank"), F.lit(0.0).alias("last")),
        "ranks",
        watched,
    )
    out_of = state.df.select(F.col("id").alias("src"), "parts")
    laid_out = Stage(
        distinct_edges.join(out_of, "src")
        .join(state.df.select(F.col("id").alias("dst")), "dst", "left_semi")
        .select("src", F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("part"), "dst"),
        "edges",
    )
    kept = {"degree": "long", "parts": "int", "rank": "double"}
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routes = laid_out.df.repartition(n_parts, "src", "part").persist()
    try:
        for _ in range(max_rounds):
            held = state.sums["held"] or 0.0
            share = state.df.filter("degree > 0").select(
                F.col("id").alias("src"),
                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                (F.col("rank") / F.col("degree")).alias("share"),
            )
            # What a node receives and what it holds meet in one aggregation, without another join.
            received = routes.join(share, ["src", "part"]).select(
                F.col("dst").alias("id"), "share", *[F.lit(None).cast(t).alias(c) for c, t in kept.items()]
            )
            own = state.df.select("id", F.lit(0.0).alias("share"), *kept)
            met = received.unionByName(own).groupBy("id").agg(
                F.sum("share").alias("_in"), *[F.max(c).alias(c) for c in kept]
            )
            rank = F.lit((1.0 - damping) / n) + F.lit(damping) * (F.col("_in") + F.lit(held / (n - 1)))
            following = Stage(
                met.select("id", "degree", "parts", rank.alias("rank"), F.col("rank").alias("last")), "ranks", watched
            )
            state.drop()
            state = following
            if state.sums["change"] <= tolerance:
                break
        else:
            raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")
    finally:
        routes.unpersist()
        laid_out.drop()
    return state.df.select("id", "rank", "degree")


def top_ranked(ranks: DataFrame, nodes: DataFrame, *, n: int = 10, digits: int | None = None) -> DataFrame:
    """(id, title, rank) of the n best ranks, ties by id; ``digits`` rounds ranks before comparing."""
    rank = F.col("rank") if digits is None else F.round("rank", digits)
    best = ranks.select("id", rank.alias("rank")).join(nodes.select("id", "title"), "id")
    return best.orderBy(F.col("rank").desc(), "id").limit(n).select("id", "title", "rank")
