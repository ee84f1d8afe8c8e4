"""Fitted objects on disk: one small JSON document and a Parquet table per part.

The document is written last and names the tables with their columns, so a folder without it does not count, and a
table that is not what the document says is an error on loading.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from opspark.sources.sinks import path_of, versions

#: Version of the layout; a document of another version is not read.
LAYOUT = 1


def save_parts(spark: SparkSession, path: str, document: dict, tables: Mapping[str, DataFrame]) -> None:
    """Write the tables, then the document. The folder is new: a version is never written over."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    whole = {"layout": LAYOUT, "tables": {name: df.schema.simpleString() for name, df in tables.items()}, "document": document}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/document")


def load_parts(spark: SparkSession, path: str) -> tuple[dict, dict[str, DataFrame]]:
    """The document and its tables, checked against each other."""
    whole = json.loads(spark.read.text(f"{path}/document").first()["value"])
    if whole["layout"] != LAYOUT:
        raise ValueError(f"layout {whole['layout']} in {path}, {LAYOUT} expected")
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in whole["tables"]}
    for name, df in tables.items():
        if df.schema.simpleString() != whole["tables"][name]:
            raise ValueError(f"{path}/{name} holds {df.schema.simpleString()}, not {whole['tables'][name]}")
    return whole["document"], tables


def new_version(folder: str, at: datetime | None = None) -> str:
    """The path of a version named by the time."""
    return f"{folder}/{(at or datetime.now(timezone.utc)).strftime('v_%Y%m%d_%H%M%S')}"


def latest_version(spark: SparkSession, folder: str) -> str:
    """The newest version whose document is complete."""
    for name in reversed(versions(spark, folder)):
        marker, fs = path_of(spark, f"{folder}/{name}/document/_SUCCESS")
        if fs.exists(marker):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"no complete version in {folder}")
