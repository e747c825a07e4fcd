"""Registry of the named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function as a named query; without ``sql`` only its rows are checked."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from tabwright.plans import (  # noqa: F401
        queries_calibration,
        queries_drift,
        queries_features,
        queries_importance,
        queries_metrics,
        queries_models,
        queries_profile,
        queries_quality,
        queries_streaming,
        queries_transforms,
    )
