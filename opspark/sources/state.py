"""Fitted state (fill values, scales, fences, feature lists) as Parquet tables."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from opspark.session import small_rows


def save_state(spark: SparkSession, state: dict, path: str) -> None:
    """One row per entry: name and JSON value. Entries are per column, never per row of data."""
    rows = [(name, json.dumps(value)) for name, value in state.items()]
    spark.createDataFrame(rows, "name string, value string").write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dict:
    """The saved entries, lists in place of tuples."""
    return {r["name"]: json.loads(r["value"]) for r in small_rows(spark.read.parquet(path))}
