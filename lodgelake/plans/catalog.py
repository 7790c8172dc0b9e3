"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame, and the
matching DuckDB oracle SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register a query under ``key`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from lodgelake.plans import q_layers, q_primitives, q_ingest  # noqa: F401
    from lodgelake.streaming import monthly  # noqa: F401
