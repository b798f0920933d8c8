"""Merkle manifest of a dataset: a hash tree for every source and one over the sources' roots, with each row's proof.

A leaf is the hash of a row's fields, each with its length.  The leaves of a source stand in the order of their ids;
every ``ARITY`` consecutive nodes become one of the next level, until one is left.  A level is one self-join: each node
asks for the nodes beside it in its run, whose positions follow from its own (its index XOR 1 in a binary tree, the other
slots of the run otherwise); the rows are joined by (tree, position), and the rows of slot zero, which then hold their
whole run, give the parents.  The roots of the sources are the leaves of the last tree, built in the same way.

Going down again, every node takes its parent's path and puts its own siblings before it, so a row of a level meets one
row of the next: no tree, source or run is gathered anywhere but a run of ``ARITY`` hashes, and a source with a third of
all rows is spread by its positions.  Positions come from slices of the order of (source, id), counted one by one.  The
levels are written, and as many as the logarithm of the largest source.  Digests travel as 32 bytes.  The driver sees the
number of rows of the largest tree, and the root.

Defined cases: a null field is ``-``, apart from the empty one (``0:``).  A null source is a source, the first; null ids
come first in their source; rows of equal source and id stand in the order of their leaves, so it doesn't matter which
of two equal rows is which.  A source of one row has its leaf as its root; a run of one node is hashed again as long as
its tree has other nodes.  A row without siblings on its whole way has the proof of nothing, the hash of the empty
string.  A null id counts as an empty one where a row's tampering is decided.  An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import A_TO_Z, a_to_z
from tamarack.operators.ordering import global_index, running_totals
from tamarack.staging import Stage

ARITY = 16
TAMPERED_OF = 5  # one row in so many is altered, by the crc32 of its id
NOTHING = "cast('' as binary)"
STEP = "array<struct<before:binary,after:binary>>"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(*fields: Column) -> Column:
    """Hash of the fields: each ``-`` if null, else its number of bytes, a colon and itself."""
    held = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields]
    return F.unhex(sha256(F.concat(*held)))


def _beside(arity: int) -> Column:
    """Positions of a node's siblings, as far as its level has them."""
    index, n = F.col("idx"), F.col("n")
    if arity == 2:
        places = F.array(index.bitwiseXOR(F.lit(1)))
    else:
        start = index - index % arity
        places = F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda k: start + (index % arity + k) % arity)
    return F.filter(places, lambda p: p < n)


def _joined(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, idx, n, digest, ...) with ``run``: the digests of their run by position, their own among them."""
    held = [c for c in nodes.columns if c not in ("tree", "idx")]
    asked = nodes.filter("n > 1").select("tree", "idx", F.explode(_beside(arity)).alias("place"))
    given = nodes.filter("n > 1").select("tree", F.col("idx").alias("place"), "digest")
    beside = asked.join(given, ["tree", "place"]).select("tree", "idx", F.struct("place", "digest").alias("node"))
    own = nodes.select("tree", "idx", F.struct(F.col("idx").alias("place"), "digest").alias("node"), F.struct(*held).alias("held"))
    return (
        own.unionByName(beside, allowMissingColumns=True)
        .groupBy("tree", "idx")
        .agg(F.sort_array(F.collect_list("node")).alias("run"), F.first("held", ignorenulls=True).alias("held"))
        .select("tree", "idx", "held.*", "run")
    )


def _concatenated(run: Column) -> Column:
    return F.aggregate(run, F.expr(NOTHING), lambda whole, node: F.concat(whole, node["digest"]))


def ladder(nodes: DataFrame, arity: int = ARITY) -> list[Stage]:
    """The levels of all trees from nodes (tree, idx, n, digest, ...): written (..., before, after), n nodes in a tree.

    A tree is in all levels up to that of its root, where n is 1.
    """
    levels = []
    while True:
        joined = _joined(nodes, arity)
        index = F.col("idx")
        level = joined.select(
            *nodes.columns,
            _concatenated(F.filter("run", lambda node: node["place"] < index)).alias("before"),
            _concatenated(F.filter("run", lambda node: node["place"] > index)).alias("after"),
        )
        levels.append(Stage(level, "merkle-level", {"most": F.max("n")}))
        if (levels[-1].sums["most"] or 0) <= 1:
            return levels
        # Before a node of slot zero there is nothing.
        nodes = levels[-1].df.filter((F.col("n") > 1) & (index % arity == 0)).select(
            "tree",
            F.expr(f"idx div {arity}").alias("idx"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.unhex(sha256(hex_text(F.concat("digest", "after")))).alias("digest"),
        )


def descent(levels: list[Stage], above: DataFrame, arity: int = ARITY) -> DataFrame:
    """The nodes of the lowest level with ``path``, the siblings from each up to its tree's root and on by ``above``.

    ``above`` (tree, path, ...) says how the roots go on; its other columns are handed down.
    """
    handed = [c for c in above.columns if c != "tree"]
    below = None
    for height in reversed(range(len(levels))):
        level = levels[height].df
        columns = [c for c in level.columns if c not in ("before", "after")]
        ends = level.filter("n = 1").join(above, "tree").select(*columns, *handed)
        whole = ends
        if below is not None:
            up = below.df.select("tree", F.col("idx").alias("up"), *handed)
            step = F.array(F.struct("before", "after"))
            inner = level.filter("n > 1").withColumn("up", F.expr(f"idx div {arity}")).join(up, ["tree", "up"])
            inner = inner.withColumn("path", F.concat(step, "path")).select(*columns, *handed)
            whole = inner.unionByName(ends)
        if height:
            following = Stage(whole.select("tree", "idx", *handed), "merkle-paths")
            if below is not None:
                below.drop()
            levels[height].drop()
            below = following
    return whole


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(
        path, hex_text(digest), lambda node, s: sha256(F.concat(hex_text(s["before"]), node, hex_text(s["after"])))
    )


def proof(path: Column) -> Column:
    """Hash of a path's siblings, left to right, level by level."""
    return sha256(F.array_join(F.transform(path, lambda s: hex_text(F.concat(s["before"], s["after"]))), ""))


def manifest(leaves: DataFrame, *, order: list[str], arity: int = ARITY) -> tuple[DataFrame, str | None]:
    """Rows (source, digest, ...) with ``subroot`` (a digest) and ``path``, and the root; leaves stand by ``order``."""
    kept = Stage(leaves, "merkle-leaves")
    by_source = kept.df.groupBy("source").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    numbered = running_totals(by_source, [F.col("source").asc_nulls_first()], {"upto": "n", "nth": "one"})
    sources = Stage(
        numbered.select(
            F.col("source").alias("of"), (F.col("nth") - 1).alias("tree"), (F.col("upto") - F.col("n")).alias("start"), "n"
        ),
        "merkle-sources",
        {"n": F.count("*")},
    )
    placed = global_index(kept.df, [F.col("source").asc_nulls_first(), *order], index="nth")
    nodes = placed.join(sources.df, F.col("source").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("nth") - F.col("start")).alias("idx"), "n", *leaves.columns
    )
    trees = ladder(nodes, arity)
    kept.drop()
    roots = [t.df.filter("n = 1").select("tree", "digest") for t in trees]
    tops = reduce(DataFrame.unionByName, roots).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(sources.sums["n"] or 0).cast("long").alias("n"), "digest"
    )
    top = ladder(tops, arity)
    root = top[-1].df.filter("n = 1").select(hex_text(F.col("digest"))).first()
    no_more = leaves.sparkSession.range(1).select(F.col("id").alias("tree"), F.array().cast(STEP).alias("path"))
    done = descent(top, no_more, arity)
    above = Stage(done.select(F.col("idx").alias("tree"), "path", F.col("digest").alias("subroot")), "merkle-roots")
    for stage in (sources, *top):
        stage.drop()
    return descent(trees, above.df, arity).select(*leaves.columns, "subroot", "path"), root[0] if root else None


def op11(docs: DataFrame) -> DataFrame:
    """Every row's leaf, roots and proof, and what is folded from it after one row in five has been altered."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").cast("string").alias("chars"),
        F.col("text").cast("string").alias("text"),
    )
    id_text = F.col("doc_id").cast("string")
    tampered = F.crc32(F.coalesce(id_text, F.lit("")).cast("binary")) % TAMPERED_OF == 0
    lower = F.translate("text", A_TO_Z, a_to_z)
    fields = [id_text, F.col("source"), F.col("lang"), F.col("chars")]
    leaves = plain.select(
        "doc_id", "source", leaf(*fields, F.col("text")).alias("digest"), F.when(tampered, leaf(*fields, lower)).alias("altered")
    )
    rows, root = manifest(leaves, order=["doc_id", "digest"])
    last = F.lit(root).cast("string")
    return rows.withColumn("end", folded(F.coalesce("altered", "digest"), F.col("path"))).select(
        "doc_id",
        hex_text(F.col("digest")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        last.alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        F.col("end").alias("folded_root"),
        (F.col("end") == last).alias("verified"),
    )


SQL_LEVELS = 6  # unrolled: up to 16^6 rows of a source


def _sql_levels(name: str, rows: str) -> str:
    """CTEs that build the levels of trees from {name}0 (tree, idx, n, digest) and fold ``rows`` along them."""
    out = []
    for k in range(SQL_LEVELS):
        out.append(f"""{name}r{k} AS MATERIALIZED (
  SELECT tree, idx // {ARITY} AS run, any_value(n) AS n, list(digest ORDER BY idx) AS l FROM {name}{k} WHERE n > 1 GROUP BY ALL
), {name}{k + 1} AS MATERIALIZED (
  SELECT tree, run AS idx, (n + {ARITY - 1}) // {ARITY} AS n, sha256(array_to_string(l, '')) AS digest FROM {name}r{k}
  UNION ALL SELECT * FROM {name}{k} WHERE n = 1
), {rows}{k + 1} AS MATERIALIZED (
  SELECT d.* EXCLUDE (place, proof, folded), CASE WHEN l IS NULL THEN place ELSE place // {ARITY} END AS place,
    CASE WHEN l IS NULL THEN proof
      ELSE proof || array_to_string(l[1:place % {ARITY}], '') || array_to_string(l[place % {ARITY} + 2:], '') END AS proof,
    CASE WHEN l IS NULL THEN folded
      ELSE sha256(array_to_string(l[1:place % {ARITY}], '') || folded || array_to_string(l[place % {ARITY} + 2:], '')) END AS folded
  FROM {rows}{k} d LEFT JOIN {name}r{k} r ON r.tree = d.tree AND r.run = d.place // {ARITY}
)""")
    return ", ".join(out)


def _sql_leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f}))::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


# crc32 of a decimal text: each byte, and after it eight turns of the register.
_SQL_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(coalesce(doc_id::VARCHAR, ''), '') IF c <> ''])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""

ORACLE = f"""
WITH leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, {_sql_leaf("text")} AS leaf,
    {_sql_leaf(f"translate(text, '{A_TO_Z}', '{a_to_z}')")} AS altered, {_SQL_CRC} % {TAMPERED_OF} = 0 AS is_altered
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), s0 AS MATERIALIZED (SELECT tree, place AS idx, n, leaf AS digest FROM placed),
d0 AS MATERIALIZED (
  SELECT r, doc_id, leaf, tree, place, '' AS proof, CASE WHEN is_altered THEN altered ELSE leaf END AS folded FROM placed
), {_sql_levels("s", "d")},
t0 AS MATERIALIZED (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, digest FROM s{SQL_LEVELS}),
e0 AS MATERIALIZED (
  SELECT d.* EXCLUDE (tree, place), 0 AS tree, d.tree AS place, s.digest AS subroot
  FROM d{SQL_LEVELS} d JOIN s{SQL_LEVELS} s ON s.tree = d.tree
), {_sql_levels("t", "e")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM e{SQL_LEVELS}, (SELECT digest AS root FROM t{SQL_LEVELS})
"""
