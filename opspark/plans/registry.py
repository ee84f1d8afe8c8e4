"""Registry of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opspark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query, the inventory rows it covers and, where there is one, its SQL."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")
