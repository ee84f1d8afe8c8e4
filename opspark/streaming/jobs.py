"""Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from opspark.operators.drift import recent_drift
from opspark.operators.metrics import fold_requests
from opspark.sources.readers import accepted, parse_readings
from opspark.sources.sinks import LatestTable, path_of, to_messages
from opspark.streaming.sensor import event_time, nested, window_features, window_means


def use_rocksdb(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, so it may exceed executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _start(writer, trigger: str | None):
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def run_stages(stages: Sequence[DataFrame], folder: str, start) -> None:
    """Run a job over messages that come stage by stage, with a restart from its checkpoint after each.

    A stage's ``value`` rows are written as text files to a folder of their own; ``start(stream)`` begins the job over all folders and
    the job takes what is new, to the end.
    """
    spark = stages[0].sparkSession
    for number, stage in enumerate(stages):
        stage.select("value").write.text(f"{folder}/stage={number:04d}")
        stream = spark.readStream.schema("value string").format("text").load(f"{folder}/stage=*")
        start(stream.select("value")).awaitTermination()


def sensor_feature_messages(messages: DataFrame, width: str = "1 minute", delay: str = "5 seconds") -> DataFrame:
    """JSON readings in, JSON window features out."""
    readings = event_time(accepted(parse_readings(messages)), delay=delay)
    return to_messages(nested(window_features(readings, width=width)))


def run_feature_job(messages: DataFrame, out: str, checkpoint: str, sink: str = "files", width: str = "1 minute",
                    delay: str = "5 seconds", trigger: str | None = "30 seconds", **options):
    """Window features to a message topic (at least once), text files or the console."""
    rows = sensor_feature_messages(messages, width, delay)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if sink == "kafka":
        writer = writer.format("kafka").option("topic", out)
        for name, value in options.items():
            writer = writer.option(name.replace("__", "."), value)
    elif sink == "console":
        writer = writer.format("console").option("truncate", False)
    elif sink == "files":
        writer = writer.format("text").option("path", out)
    else:
        raise ValueError(f"unknown sink: {sink}")
    return _start(writer, trigger)


def run_online_job(messages: DataFrame, table: LatestTable, checkpoint: str, width: str = "1 minute",
                   trigger: str | None = "30 seconds"):
    """Window means (watermark without delay) upserted in a keyed latest table, once per batch number."""
    readings = event_time(accepted(parse_readings(messages)), delay="0 seconds")
    means = window_means(readings, width=width).withColumnRenamed("ts", "event_timestamp")
    writer = (means.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, number: table.apply(batch, number)))
    return _start(writer, trigger)


def run_drift_job(log: DataFrame, tails: str, metrics: str, checkpoint: str,
                  cols: Sequence[str] = ("feature", "pred", "actual"), order: str = "ts", n: int = 50,
                  trigger: str | None = "60 seconds"):
    """On every trigger append the drift of the newest rows to a metrics table.

    Only the newest ``2 n`` rows and the running row count are carried from
    batch to batch; both are written under the batch number, so a replay
    writes the same folders again. A batch is read once: its rows are counted while the newest are
    picked. Of rows of one time those with the greater values of ``cols`` count as newer, so that
    a rerun picks the same rows. Tails before the former batch are removed.
    """
    from pyspark.sql import Observation

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen, before = Observation(), 0
        tail = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        if number > 0:
            tail = spark.read.schema(batch.schema).parquet(f"{tails}/batch={number - 1:012d}").unionByName(tail)
            before = spark.read.parquet(f"{metrics}/batch={number - 1:012d}").first()["data_points"]
        tail = tail.orderBy(F.col(order).desc(), *[F.col(c).desc() for c in cols if c != order]).limit(2 * n)
        tail.write.mode("overwrite").parquet(f"{tails}/batch={number:012d}")
        kept = spark.read.schema(batch.schema).parquet(f"{tails}/batch={number:012d}")
        row = recent_drift(kept, order, cols, n).select(
            "*", F.lit(before + seen.get["rows"]).cast("bigint").alias("data_points"),
            F.current_timestamp().alias("checked_at"))
        row.write.mode("overwrite").parquet(f"{metrics}/batch={number:012d}")
        if number > 1:
            path, fs = path_of(spark, f"{tails}/batch={number - 2:012d}")
            fs.delete(path, True)

    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return _start(writer, trigger)


def run_request_job(requests: DataFrame, out: str, checkpoint: str, by: Sequence[str], bounds: Sequence[float],
                    ts: str = "ts", status: str = "status", latency: str = "latency_ms", delay: str = "5 seconds",
                    step: int = 30, trigger: str | None = "30 seconds"):
    """Fold requests to one final row per ``step`` and group.

    ``kpis_from_panes`` turns these few rows into the sliding KPI table.
    """
    timed = requests.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    rows = fold_requests(timed, by, ts, status, latency, bounds, step)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint)
    return _start(writer, trigger)
