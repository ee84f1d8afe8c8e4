"""Sinks: partitioned files, metric tables, versioned artefacts, keyed latest tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from opspark.operators.store import merge_latest
from opspark.session import cut_lineage


def write_splits(df: DataFrame, path: str, name: str = "split") -> None:
    """One folder per part of the split."""
    df.write.mode("overwrite").partitionBy(name).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append a long metrics table as JSON lines."""
    metrics.write.mode("append").json(path)


def metrics_table(spark: SparkSession, values: dict, run_at: datetime | None = None) -> DataFrame:
    """Nested metrics as ``(run_at, metric, value)`` with dotted names; values are JSON text."""
    stamp = run_at or datetime.now(timezone.utc)

    def flat(prefix, node):
        if isinstance(node, dict):
            for k, v in node.items():
                yield from flat(f"{prefix}.{k}" if prefix else str(k), v)
        else:
            yield stamp, prefix, json.dumps(node, default=str)

    return spark.createDataFrame(list(flat("", values)), "run_at timestamp, metric string, value string")


def append_history(df: DataFrame, path: str, event_time: str) -> None:
    """Append feature history partitioned by event date."""
    df.withColumn("event_date", F.to_date(event_time)).write.mode("append").partitionBy("event_date").parquet(path)


def write_evidence(df: DataFrame, path: str, at: str = "timestamp") -> None:
    """Evidence under year / month / day / run folders."""
    day = F.to_timestamp(F.col(at))
    df.select(
        "*", F.date_format(day, "yyyy").alias("year"), F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"), F.col("run_id").alias("run")
    ).write.mode("append").partitionBy("year", "month", "day", "run").json(path)


def evidence_path(at: Column, run_id: Column) -> Column:
    """``YYYY/MM/DD/<run>.json``."""
    return F.concat(F.date_format(at, "yyyy/MM/dd"), F.lit("/"), run_id.cast("string"), F.lit(".json"))


def version_stamp(at: Column) -> Column:
    """``v_YYYYmmdd_HHMMSS``."""
    return F.concat(F.lit("v_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def path_of(spark: SparkSession, path: str):
    """The path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Version folders in order; the last is the latest."""
    p, fs = path_of(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("v_"))


def save_version(model, spark: SparkSession, folder: str, at: datetime | None = None) -> str:
    """Save a fitted Spark ML model under a new version name."""
    stamp = (at or datetime.now(timezone.utc)).strftime("v_%Y%m%d_%H%M%S")
    model.write().save(f"{folder}/{stamp}")
    return stamp


def load_latest(spark: SparkSession, folder: str):
    """Load the newest version of a pipeline model."""
    from pyspark.ml import PipelineModel

    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"no versions in {folder}")
    return PipelineModel.load(f"{folder}/{found[-1]}")


class LatestTable:
    """A keyed table of newest rows in hash parts, with one small manifest per applied batch.

    A key's part is the hash of the key. A batch is merged with the parts that its keys fall in, and only these are written anew,
    under the batch's number; the manifest names the folder of each part, so all others stay the files they were. The
    manifest is renamed into place when the data is written: a writer lost half-way leaves the former one in force, and
    a replayed batch changes nothing. Folders that none of the last ``keep`` manifests names are removed, so readers of the former
    manifest are not disturbed. ``parts`` is fixed when the table is made, for the size that it will have.
    """

    def __init__(self, path: str, keys: Sequence[str], event_time: str, parts: int = 64, keep: int = 2):
        self.path, self.keys, self.event_time, self.parts, self.keep = path, list(keys), event_time, parts, max(1, keep)

    def manifests(self, spark: SparkSession) -> list[int]:
        """Numbers of the applied batches whose manifests are kept, in order."""
        p, fs = path_of(spark, f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, spark: SparkSession, batch_id: int) -> dict:
        """``schema`` and, by part, the batch that wrote it last."""
        p, fs = path_of(spark, f"{self.path}/manifest/{batch_id:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, spark: SparkSession, batch_id: int, manifest: dict) -> None:
        temporary, fs = path_of(spark, f"{self.path}/manifest/.{batch_id:012d}.tmp")
        final, _ = path_of(spark, f"{self.path}/manifest/{batch_id:012d}.json")
        stream = fs.create(temporary, True)
        stream.writeBytes(json.dumps(manifest))
        stream.close()
        if not fs.rename(temporary, final):
            raise OSError(f"batch {batch_id} of {self.path} was published by another writer")

    def _folder(self, part: str, batch_id: int) -> str:
        return f"{self.path}/data/batch={batch_id:012d}/part={part}"

    def _rows(self, spark: SparkSession, manifest: dict, parts) -> DataFrame | None:
        found = [self._folder(p, manifest["parts"][p]) for p in parts if p in manifest["parts"]]
        return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(*found) if found else None

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows as of the last batch; None before the first."""
        done = self.manifests(spark)
        if not done:
            return None
        manifest = self.manifest(spark, done[-1])
        return self._rows(spark, manifest, sorted(manifest["parts"]))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one batch; empty and replayed batches are no-ops."""
        from opspark.operators.store import latest

        spark = batch.sparkSession
        done = self.manifests(spark)
        if done and batch_id <= done[-1]:
            return
        values = [c for c in batch.columns if c not in self.keys and c != self.event_time]
        newest = cut_lineage(latest(batch, self.keys, self.event_time, values).select(*batch.columns))
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("string")
        touched = sorted(r[0] for r in newest.select(part).distinct().collect())  # at most one per part
        if not touched:
            return
        manifest = self.manifest(spark, done[-1]) if done else {"schema": newest.schema.jsonValue(), "parts": {}}
        # a batch has the columns of the table; types are those of the first batch
        newest = newest.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in StructType.fromJson(manifest["schema"])])
        old = self._rows(spark, manifest, touched)
        merged = newest if old is None else merge_latest(old, newest, self.keys, self.event_time)
        merged.withColumn("part", part).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/data/batch={batch_id:012d}")
        self._publish(spark, batch_id, {"schema": manifest["schema"], "parts": manifest["parts"] | dict.fromkeys(touched, batch_id)})
        self._clean(spark, [*done, batch_id])

    def _clean(self, spark: SparkSession, done: list[int]) -> None:
        """Remove what only dropped manifests name."""
        dropped, kept = done[: -self.keep], done[-self.keep :]
        if not dropped:
            return
        named = {(p, b) for d in kept for p, b in self.manifest(spark, d)["parts"].items()}
        for d in dropped:
            for p, b in self.manifest(spark, d)["parts"].items():
                if (p, b) not in named:
                    path, fs = path_of(spark, self._folder(p, b))
                    fs.delete(path, True)
            path, fs = path_of(spark, f"{self.path}/manifest/{d:012d}.json")
            fs.delete(path, False)


def to_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``, for a message sink."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
