"""Queries that go through readers, sinks and streams, by way of the shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from opspark.operators import metrics as me
from opspark.plans.evaluation_queries import recent_sql
from opspark.plans.feature_queries import rounded
from opspark.plans.registry import query, table
from opspark.plans.service_queries import BOUNDS, REQUEST_SQL, kpi_sql
from opspark.session import shared_folder
from opspark.sources import readers as rd, schemas, sinks as sk
from opspark.streaming import jobs


def scratch(spark) -> str:
    """A new folder under the shared one."""
    return f"{shared_folder(spark)}/opspark-{uuid.uuid4().hex}"


@contextmanager
def local_state(spark):
    """On a local master, keep stream state in as many parts as there are cores."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("csv_prediction_log", "S2", """
SELECT round(epoch_us(ts) / 1000000.0, 3)::DOUBLE AS ts, value AS feature, round(value * 0.5, 4) AS pred, user_id::DOUBLE AS actual FROM events""")
def _(spark, sf):
    path = scratch(spark)
    e = table(spark, sf, "events")
    at = F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0, 3)
    log = e.select(at.cast("string"), F.col("value").cast("string"), F.round(F.col("value") * 0.5, 4).cast("string"),
                   F.col("user_id").cast("string"))
    # every file starts with a stray header line, as the log writer leaves one
    log.write.option("header", True).csv(path)
    return rd.read_prediction_log(spark, path)


@query("csv_feature_history", "S1 S3", """
SELECT user_id AS driver_id, value::FLOAT AS conv_rate, 0.5::FLOAT AS acc_rate, event_id AS avg_daily_trips, epoch_us(ts) // 1000000 AS at FROM events
""".replace("AS at", 'AS "at"'))
def _(spark, sf):
    path = scratch(spark)
    e = table(spark, sf, "events")
    e.select(F.col("user_id").alias("driver_id"), F.col("value").alias("conv_rate"), F.lit(0.5).alias("acc_rate"),
             F.col("event_id").alias("avg_daily_trips"),
             F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_timestamp")
             ).write.option("header", True).csv(path)
    out = rd.read_feature_history(spark, path)
    return out.select("driver_id", "conv_rate", "acc_rate", "avg_daily_trips", F.unix_seconds("event_timestamp").alias("at"))


@query("folder_and_latest_batch", "S4 S5 S6 T4", """
SELECT 'all' AS part, count(*) AS rows, round(sum(value), 2) AS total FROM events
UNION ALL SELECT 'latest', count(*), round(sum(value), 2) FROM events WHERE event_type = 'view'""")
def _(spark, sf):
    path = scratch(spark)
    e = table(spark, sf, "events")
    for kind in ("click", "error", "purchase", "signup", "view"):
        e.where(F.col("event_type") == kind).write.parquet(f"{path}/batch_{kind}.parquet")

    def total(df, part):
        return df.select(F.lit(part).alias("part"), "value").groupBy("part").agg(
            F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total"))

    return total(rd.read_folder(spark, path), "all").unionByName(total(rd.read_latest_batch(spark, path), "latest"))


@query("features_with_target", "S7", "SELECT o_orderkey, o_totalprice, (o_orderstatus = 'F')::INT AS target FROM orders")
def _(spark, sf):
    path = scratch(spark)
    o = table(spark, sf, "orders")
    o.select("o_orderkey", "o_totalprice").write.parquet(f"{path}/x")
    o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("target")).write.parquet(f"{path}/y")
    return rd.read_with_target(spark, f"{path}/x", f"{path}/y", "o_orderkey")


@query("history_append", "S15 W2", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def _(spark, sf):
    path = scratch(spark)
    e = table(spark, sf, "events").select("user_id", F.col("ts").alias("event_timestamp"), "value")
    late = F.col("event_timestamp") >= F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    sk.append_history(e.where(~late), path, "event_timestamp")
    sk.append_history(e.where(late), path, "event_timestamp")
    back = spark.read.parquet(path)
    return rounded(back.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("rows"), F.sum("value").alias("total")))


@query("reloaded_model_agreement", "M24 M23 S14")
def _(spark, sf):
    from opspark.operators import models as mo

    path = scratch(spark)
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    cols = ["o_totalprice", "month"]
    model = mo.fit_forest(o, cols, trees=5, max_depth=4)
    sk.save_version(model, spark, path)
    both = [mo.score_table(m, o, cols, ["o_orderkey"]) for m in (model, sk.load_latest(spark, path))]
    return mo.agreement(*both, "o_orderkey")


# -- streams run to the end of the given events; windows still open are not emitted ----

@query("stream_window_features", "R1 R2 R4 R6 R7 R8 S8 S9 Y2", """
WITH w AS (SELECT event_type AS sensor_id, time_bucket(INTERVAL 1 DAY, ts) AS w, value FROM events),
s AS (SELECT sensor_id, w, avg(value) AS a, stddev_pop(value) AS s FROM w GROUP BY 1, 2)
SELECT sensor_id, epoch_ms(w)::BIGINT AS window_start, count(*) AS count, round(any_value(a)::DECIMAL(30, 9), 2)::DOUBLE AS avg_value, round(any_value(s)::DECIMAL(30, 9), 2)::DOUBLE AS std_dev,
  count(*) FILTER (abs(value - a) > 2.5 * s) AS anomaly_count
FROM w JOIN s USING (sensor_id, w) WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events) GROUP BY sensor_id, w""")
def _(spark, sf):
    path = scratch(spark)
    kind = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), F.unix_millis("ts").alias("timestamp"), "value"))
    messages = event_stream(spark, sf).select(kind.alias("value"))
    with local_state(spark):
        jobs.run_feature_job(messages, f"{path}/out", f"{path}/state", width="1 day", trigger=None).awaitTermination()
    sent = spark.read.text(f"{path}/out").select(F.from_json("value", schemas.WINDOW_FEATURES).alias("m"))
    return sent.select("m.sensor_id", "m.window_start", *[f"m.features.{f}" for f in ("count", "avg_value", "std_dev", "anomaly_count")])


@query("stream_online_table", "R3 R9 S16", """
WITH w AS (SELECT event_type AS sensor_id, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS e, value FROM events),
m AS (SELECT sensor_id, e, avg(value) AS v FROM w GROUP BY 1, 2 HAVING e <= (SELECT max(ts) FROM events))
SELECT sensor_id, epoch_ms(max(e))::BIGINT AS event_ms, round(arg_max(v, e), 4) AS avg_value FROM m GROUP BY 1""")
def _(spark, sf):
    path = scratch(spark)
    kind = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), F.unix_millis("ts").alias("timestamp"), "value"))
    kept = sk.LatestTable(f"{path}/online", ["sensor_id"], "event_timestamp")
    with local_state(spark):
        jobs.run_online_job(event_stream(spark, sf).select(kind.alias("value")), kept, f"{path}/state", "1 hour", None).awaitTermination()
    return kept.read(spark).select("sensor_id", F.unix_millis("event_timestamp").alias("event_ms"), F.round("avg_value", 4).alias("avg_value"))


@query("stream_request_kpis", "R11 W6 R8", f"""
WITH b AS (SELECT max(ts) - INTERVAL 5 SECOND AS b FROM events), {kpi_sql().replace(f'q AS ({REQUEST_SQL})', f'''q AS (SELECT r.* FROM ({REQUEST_SQL}) r, b
  WHERE (floor(epoch_us(ts) / 1000000.0 / 3600) + 1) * 3600 <= epoch_us(b) / 1000000.0)''')}
SELECT version, eval_at, round(request_rate, 6) AS request_rate, round(success_rate, 6) AS success_rate, round(error_rate, 6) AS error_rate,
  round(latency_quantile, 4) AS latency_quantile FROM k""")
def _(spark, sf):
    path = scratch(spark)
    kind = F.col("event_type")
    log = event_stream(spark, sf).select(
        "ts", F.when(F.col("user_id") % 10 == 0, "v2").otherwise("v1").alias("version"),
        F.when(kind == "error", "503").when(kind == "signup", "201").otherwise("200").alias("status"), F.col("value").alias("latency_ms"))
    with local_state(spark):
        jobs.run_request_job(log, f"{path}/panes", f"{path}/state", ["version"], BOUNDS, step=3600, trigger=None).awaitTermination()
    out = me.kpis_from_panes(spark.read.parquet(f"{path}/panes"), ["version"], BOUNDS, 3600, 14400)
    return rounded(rounded(out, "request_rate", "success_rate", "error_rate", places=6), "latency_quantile")


@query("stream_drift_check", "R10 A30", recent_sql().replace(
    "SELECT count(*) FILTER (p < 0.05) AS drifted_columns", "SELECT (SELECT count(*) FROM events) AS data_points, count(*) FILTER (p < 0.05) AS drifted_columns"))
def _(spark, sf):
    path = scratch(spark)
    with local_state(spark):
        jobs.run_drift_job(event_stream(spark, sf).select("ts", "user_id", "value"), f"{path}/tails", f"{path}/metrics", f"{path}/state",
                           ["user_id", "value"], "ts", trigger=None).awaitTermination()
    return spark.read.parquet(f"{path}/metrics/*").drop("checked_at")
