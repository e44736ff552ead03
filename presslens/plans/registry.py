"""Registry of runnable queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register `f(spark, folder) -> DataFrame` under a name, with SQL if it has any."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql.strip()
        return fn

    return add


def load_all() -> None:
    """Import the modules that register queries."""
    from presslens.plans import (  # noqa: F401
        queries_aggregates,
        queries_cleaning,
        queries_evaluation,
        queries_joins,
        queries_composites,
        queries_ranking,
        queries_sources,
        queries_statistics,
        queries_text,
        queries_vectors,
    )
