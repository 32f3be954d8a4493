"""The registered queries, each with the SQL that gives the same rows.

A query is a function of :class:`tidemark.sources.readers.Tables`. Queries read whole tables; a filter stands only where it
is what the query shows, such as an earlier state of a table or the gaps of a lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.sources.readers import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql.strip() if sql else None)
        return build

    return register


def load() -> dict[str, Query]:
    """Import every catalog module and return the queries."""
    from tidemark.catalog import (  # noqa: F401
        aggregates,
        expressions,
        history,
        incremental,
        joins,
        loads,
        models,
        quality,
        windows,
    )

    return QUERIES
