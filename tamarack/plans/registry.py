"""Small decorator that collects a family's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    queries: dict = {}
    oracles: dict[str, str] = {}

    def register(name: str, sql: str | None = None):
        def keep(run):
            queries[name] = run
            if sql is not None:
                oracles[name] = sql
            return run

        return keep

    return queries, oracles, register
