"""Registry of named queries over the driver tables.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over whole tables;
most carry an equivalent DuckDB SQL text used as the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DESCRIPTIONS: dict[str, str] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    """Decorator: add a query (and its oracle SQL, when SQL can express it)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        DESCRIPTIONS[name] = ids
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from starweave.plans import (  # noqa: F401
        flow_queries,
        function_queries,
        io_queries,
        lookup_queries,
        music_queries,
        proof_queries,
        quality_queries,
        scale_queries,
        travel_queries,
    )
