"""Query catalogue: every registered query takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole test tables.  Queries whose result is expressible in SQL also carry an equivalent DuckDB
statement used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tessera.plans import (  # noqa: F401
        q_aggregates,
        q_filters,
        q_joins,
        q_metrics,
        q_ml,
        q_ordering,
        q_privacy,
        q_scalars,
        q_sources,
        q_streaming,
        q_text,
        q_udfs,
        q_windows,
    )
