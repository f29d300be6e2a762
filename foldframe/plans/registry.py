"""Registry of the queries the driver runs: key -> (Spark builder, oracle SQL)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its DuckDB oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise KeyError(f"query {key} registered twice")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn

    return deco


def _load_all() -> None:
    from . import (  # noqa: F401
        q_atoms,
        q_chains,
        q_geometry,
        q_io,
        q_labels,
        q_search,
        q_summary,
    )


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
