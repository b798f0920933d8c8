"""Registered queries: each operator applied to the given tables, with the SQL it must agree with."""

from __future__ import annotations

from tamarack.plans import graph, learning, records, relational, sampling, text, vectors

FAMILIES = (records, relational, text, graph, vectors, learning, sampling)


def all_queries() -> dict:
    return {name: run for family in FAMILIES for name, run in family.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}
