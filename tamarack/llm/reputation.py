"""URL filters: fixed rules first, then the reputation of a page's host by empirical Bayes.

A rule names a host and the beginning of a path; it fits that host and all its subdomains, and the longest that fits
decides.  What no rule decides is judged by its host.  Pages with a known outcome (``bad`` true or false) are counted by
host; a host's share of bad pages has a beta prior around that of its registered domain, a domain's around that of its
public suffix, and a suffix's around that of all labelled pages.  How strongly a level is drawn to the one above is
learnt from all its groups by moments: with ``m`` the mean above, ``y`` of ``n`` pages bad and ``r`` the correlation of
two pages of a group, the expected ``(y - n m)^2`` is ``n m (1 - m) (1 + (n - 1) r)``, and the prior counts for
``1 / r - 1`` pages.  A host is blocked where the lower bound of its bad share, the posterior mean less ``CAUTION``
posterior standard deviations, reaches ``LIMIT``: little evidence blocks nothing.

No table labels pages, so the registered query takes the pages that a rule decides as the labelled ones; ``judged`` takes
any.  Pages are counted by partial aggregates before a shuffle, so a host with a third of all rows is a row per task.
The pages meet one row per host; its table is written, so the planner knows its size and broadcasts it only if small, and
may split a hot host otherwise.  The driver sees six numbers in all.  Everything is JVM-side.

Defined cases: a null url, or one without ``://``, has an empty host and path, and no rule fits; all of those share one
reputation.  User, port and a last dot are part of ``host`` but not of the name that a reputation belongs to.  A
numeric address and a name without dots are their own domain, of the empty suffix.  Of equally long rules that fit, the
one of the longer host counts, of equal ones the blocking one.  Repeated rows and null page ids are judged like
others, and each labelled row counts.  A suffix without labelled pages has the prior alone; without any labelled page
nothing is blocked but by rules.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import A_TO_Z, a_to_z
from tamarack.staging import Stage

# (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
LIMIT, CAUTION = 0.5, 1.645
# Strength of a prior, in pages: where it can't be estimated, and the least and most it may have.
UNKNOWN, WEAKEST, STRONGEST = 2.0, 0.1, 10_000.0
# Public suffixes of two labels (fixed values, a parameter of ``judged``).
SUFFIXES = (
    "ac.uk co.uk gov.uk org.uk com.au net.au org.au co.nz co.jp ne.jp or.jp co.kr co.in com.br com.mx com.cn com.tr co.za"
).split()
PLACES = 6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, and from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), A_TO_Z, a_to_z)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def deciding_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block", r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in reversed(order):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def names(host: Column, suffixes: Sequence[str]) -> tuple[Column, Column, Column]:
    """A host's own name, its registered domain and its public suffix."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    plain = (F.size(labels) < 2) | name.rlike(r"^[0-9.]+$|[\[\]:]")
    last_two = F.concat_ws(".", F.slice(labels, -2, 2))
    long = (F.size(labels) > 2) & last_two.isin(list(suffixes))
    suffix = F.when(plain, F.lit("")).when(long, last_two).otherwise(F.element_at(labels, -1))
    domain = (
        F.when(plain, name).when(long, F.concat_ws(".", F.slice(labels, -3, 3))).otherwise(last_two)
    )
    return name, domain, suffix


def _strength(groups: DataFrame) -> float:
    """Pages that the prior of a level counts for, from its groups (n, bad, m)."""
    known = groups.filter((F.col("n") > 0) & (F.col("m") > 0) & (F.col("m") < 1))
    off = F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) / (F.col("m") * (1 - F.col("m")))
    excess, pairs = known.agg(F.sum(off - F.col("n")), F.sum(F.col("n") * (F.col("n") - 1))).first()
    if not pairs:
        return UNKNOWN
    shared = min(max(excess / pairs, 1 / (STRONGEST + 1)), 1 / (WEAKEST + 1))
    return 1 / shared - 1


def _drawn(strength: float) -> Column:
    return (F.col("bad") + F.lit(strength) * F.col("m")) / (F.col("n") + F.lit(strength))


def reputations(hosts: DataFrame) -> DataFrame:
    """(name, evidence, bad_share, bound) from the labelled pages counted by host: (name, domain, suffix, n, bad)."""
    whole = hosts.agg(F.sum("n"), F.sum("bad")).first()
    mean = ((whole[1] or 0) + 0.5) / ((whole[0] or 0) + 1.0)
    totals = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(*totals).withColumn("m", F.lit(mean))
    suffixes = suffixes.select("suffix", _drawn(_strength(suffixes)).alias("m"))
    domains = hosts.groupBy("domain", "suffix").agg(*totals).join(suffixes, "suffix")
    domains = Stage(domains.select("domain", "suffix", "n", "bad", "m"), "reputation-domains")
    above = domains.df.select("domain", "suffix", _drawn(_strength(domains.df)).alias("m"))
    placed = Stage(hosts.join(above, ["domain", "suffix"]).select("name", "n", "bad", "m"), "reputation-hosts")
    domains.drop()
    strength = _strength(placed.df)
    weight = F.col("n") + F.lit(strength)
    share = _drawn(strength)
    bound = F.greatest(share - CAUTION * F.sqrt(share * (1 - share) / (weight + 1)), F.lit(0.0))
    return placed.df.select(
        "name", F.col("n").alias("evidence"), F.round(share, PLACES).alias("bad_share"), F.round(bound, PLACES).alias("bound")
    )


def judged(
    pages: DataFrame,
    *,
    rules: Sequence[tuple[str, str, str]] = RULES,
    bad: Column | None = None,
    limit: float = LIMIT,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, evidence, bad_share, bound) of every page (page_id, url).

    ``bad`` is a boolean column of ``pages`` that tells the outcome of labelled pages and is null for others; by default
    the pages that a rule decides are the labelled ones.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    parted = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), (F.lit(None).cast("boolean") if bad is None else bad).alias("label"))
    parted = parted.withColumn("d", deciding_rule(F.col("host"), F.col("path"), rules))
    outcome = F.col("d.verdict") == "block" if bad is None else F.col("label")
    name, domain, suffix = names(F.col("host"), suffixes)
    # By host as it is written first: its names are then taken apart once per host, not once per page.
    counted = parted.groupBy("host").agg(
        F.count(outcome).alias("n"), F.coalesce(F.sum(outcome.cast("long")), F.lit(0)).alias("bad")
    )
    hosts = Stage(
        counted.withColumn("name", name)
        .withColumn("domain", domain)
        .withColumn("suffix", suffix)
        .groupBy("name", "domain", "suffix")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")),
        "reputation-counts",
    )
    known = Stage(reputations(hosts.df), "reputations")
    hosts.drop()
    verdict = F.coalesce(F.col("d.verdict"), F.when(F.col("bound") >= limit, F.lit("block")).otherwise(F.lit("allow")))
    return (
        parted.withColumn("name", name)
        .join(known.df, "name")
        .select("page_id", "host", "path", F.col("d.rule").alias("rule"), verdict.alias("verdict"), "evidence", "bad_share", "bound")
    )


def op13(pages: DataFrame) -> DataFrame:
    return judged(pages)


def _level(name: str, groups: str, mean: str) -> str:
    """CTEs that estimate the strength of a level's prior from its groups (n, bad, m) and draw them to their means."""
    return f"""{name}_s AS (
  SELECT CASE WHEN coalesce(pairs, 0) = 0 THEN {UNKNOWN}::DOUBLE
    ELSE 1.0::DOUBLE / least(greatest(excess / pairs, 1.0::DOUBLE / {STRONGEST + 1}::DOUBLE), 1.0::DOUBLE / {WEAKEST + 1}::DOUBLE) - 1 END AS strength
  FROM (SELECT sum((bad - n * m) ** 2 / (m * (1 - m)) - n) AS excess, sum(n * (n - 1))::DOUBLE AS pairs
    FROM {groups} WHERE n > 0 AND m > 0 AND m < 1)
), {name}_m AS (
  SELECT g.*, (bad + strength * m) / (n + strength) AS {mean}, n + strength AS weight FROM {groups} g, {name}_s
)"""


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
_SUFFIX_SQL = ", ".join(f"'{s}'" for s in SUFFIXES)
ORACLE = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
parted AS (
  SELECT row_number() OVER () AS r, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{A_TO_Z}', '{a_to_z}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parted
), ruled AS (
  SELECT u.*, rule_host || rule_path AS rule, rule_verdict,
    regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') AS name
  FROM urls u LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
), parts AS (
  SELECT name, count(rule) AS n, count(*) FILTER (rule_verdict = 'block') AS bad, string_split(name, '.') AS p,
    len(p) < 2 OR regexp_matches(name, '^[0-9.]+$|[\\[\\]:]') AS plain,
    len(p) > 2 AND array_to_string(p[-2:], '.') IN ({_SUFFIX_SQL}) AS long
  FROM ruled GROUP BY name
), hosts AS (
  SELECT name, n, bad,
    CASE WHEN plain THEN name WHEN long THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain,
    CASE WHEN plain THEN '' WHEN long THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix
  FROM parts
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) FROM hosts) AS m
  FROM hosts GROUP BY suffix
), {_level("suffix", "suffixes", "drawn")}, domains AS (
  SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s.drawn) AS m
  FROM hosts h JOIN suffix_m s USING (suffix) GROUP BY ALL
), {_level("domain", "domains", "drawn")}, placed AS (
  SELECT h.name, h.n, h.bad, d.drawn AS m FROM hosts h JOIN domain_m d USING (domain, suffix)
), {_level("host", "placed", "share")}, known AS (
  SELECT name, n AS evidence, round(share, {PLACES}) AS bad_share,
    round(greatest(share - {CAUTION}::DOUBLE * sqrt(share * (1 - share) / (weight + 1)), 0.0::DOUBLE), {PLACES}) AS bound
  FROM host_m
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN bound >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  evidence, bad_share, bound
FROM ruled JOIN known USING (name)
"""
