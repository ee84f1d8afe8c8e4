"""Streams over folders of JSON lines: closed windows equal the batch result."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from opspark.operators import metrics as me
from opspark.sources import schemas
from opspark.sources.readers import accepted, message_stream, parse_readings
from opspark.sources.sinks import LatestTable
from opspark.streaming import jobs, sensor as se


def feed(folder, number, rows):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number:03d}.json")
    with open(path, "w") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def reading(sensor, second, value):
    return {"sensor_id": sensor, "timestamp": second * 1000, "value": value}


def ramp(sensor, start, n):
    return [reading(sensor, start + i, 20.0 + (i % 60) * 0.1 + (80.0 if i % 30 == 7 else 0.0)) for i in range(n)]


def sent(spark, folder):
    return [json.loads(r.value) for r in spark.read.text(folder).collect()]


def brute(rows, width=60):
    groups = {}
    for r in rows:
        groups.setdefault((r["sensor_id"], r["timestamp"] // (width * 1000)), []).append(r["value"])
    out = {}
    for key, v in groups.items():
        avg = sum(v) / len(v)
        sd = math.sqrt(sum((x - avg) ** 2 for x in v) / len(v))
        out[key] = (len(v), sum(abs(x - avg) > 2.5 * sd for x in v))
    return out


def test_stream_equals_full_window_brute_force(spark, folder):
    src, out = f"{folder}/in", f"{folder}/out"
    rows = ramp("a", 0, 300) + ramp("b", 30, 200)
    shuffled = sorted(rows, key=lambda r: (r["timestamp"] // 3000, -r["timestamp"]))  # out of order within 3 s
    for i in range(0, len(shuffled), 100):
        feed(src, i // 100, shuffled[i:i + 100] + ["broken", '{"sensor_id": "a"}'])
    feed(src, 90, [reading("z", 900, 1.0)])
    stream = message_stream(spark, "files", path=src, maxFilesPerTrigger=1)
    jobs.run_feature_job(stream, out, f"{folder}/ck", trigger=None).awaitTermination(300)
    got = {(m["sensor_id"], m["window_start"] // 60000): (m["features"]["count"], m["features"]["anomaly_count"]) for m in sent(spark, out)}
    want = brute(rows)
    assert got == want and sum(k for _, k in got.values()) > 0
    for m in sent(spark, out):
        f = m["features"]
        assert f["min_value"] <= f["avg_value"] <= f["max_value"]
        assert m["window_end"] - m["window_start"] == 60000 and "T" in m["event_time"]


def test_batch_form_gives_the_same_rows(spark, folder):
    rows = ramp("a", 0, 300)
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    out = se.window_features(se.event_time(accepted(parse_readings(df))))
    assert {("a", r.window_start // 60000): (r["count"], r.anomaly_count) for r in out.collect()} == brute(rows)


def test_readings_of_a_batch_stay_where_they_are(spark, monkeypatch):
    """Small statistics are sent to the readings; large ones meet them by shuffle, a hot window in many tasks. Both give the same rows."""
    df = se.event_time(spark.range(30_000).select(
        F.when(F.col("id") % 9 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 50)).otherwise("hot").alias("sensor_id"),
        (F.col("id") % 40 * 3000).alias("timestamp"), F.when(F.pmod(F.xxhash64("id"), F.lit(97)) == 0, 500.0).otherwise(F.col("id") % 7 * 1.0).alias("value")))
    small = se.window_features(df)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not any("Exchange hashpartitioning" in line and "_v" in line for line in plan.splitlines())
    monkeypatch.setattr(se, "fits", lambda *_: False)
    monkeypatch.setattr(se, "PART_ROWS", 1000)
    large = se.window_features(df)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert small.agg(F.sum("anomaly_count"), F.sum("count")).first()[1] == 30_000 and small.agg(F.sum("anomaly_count")).first()[0] > 100


def test_ten_high_values_among_fifty_are_no_anomaly(spark):
    rows = [reading("s", i, 20.0 + (i % 3) * 0.1) for i in range(50)] + [reading("s", 50 + i, 50.0 + (i % 3) * 0.1) for i in range(10)]
    df = spark.createDataFrame([(r["sensor_id"], r["timestamp"], r["value"]) for r in rows], schemas.SENSOR_READING)
    row = se.window_features(se.event_time(df)).first()
    assert (row["count"], row.anomaly_count, row.anomaly_rate) == (60, 0, 0.0)


def test_single_and_constant_windows(spark):
    df = spark.createDataFrame([("a", 0, 5.0), ("b", 0, 2.0), ("b", 1000, 2.0)], schemas.SENSOR_READING)
    got = {r.sensor_id: r for r in se.window_features(se.event_time(df)).collect()}
    assert got["a"].std_dev == 0.0 and got["a"]["count"] == 1 and got["b"].anomaly_count == 0


def test_late_rows_are_dropped_and_restart_continues(spark, folder):
    src, out, ck = f"{folder}/in", f"{folder}/out", f"{folder}/ck"

    def run():
        stream = message_stream(spark, "files", path=src, maxFilesPerTrigger=1)
        jobs.run_feature_job(stream, out, ck, trigger=None).awaitTermination(300)

    feed(src, 0, ramp("a", 0, 60))
    feed(src, 1, [reading("a", 130, 1.0)])
    run()
    assert [m["features"]["count"] for m in sent(spark, out)] == [60]
    feed(src, 2, [reading("a", 10, 1.0)])    # far behind the watermark
    feed(src, 3, [reading("a", 400, 1.0)])
    run()
    counts = sorted((m["window_start"], m["features"]["count"]) for m in sent(spark, out))
    assert counts == [(0, 60), (120000, 1)]


def test_online_table_from_a_stream(spark, folder):
    src = f"{folder}/in"
    feed(src, 0, [reading(s, i, float(i)) for s in "abcde" for i in range(20)])
    feed(src, 1, [reading("a", 100, 7.0)])
    feed(src, 2, [reading("z", 300, 7.0)])
    table = LatestTable(f"{folder}/online", ["sensor_id"], "event_timestamp")
    stream = message_stream(spark, "files", path=src, maxFilesPerTrigger=1)
    jobs.run_online_job(stream, table, f"{folder}/ck", trigger=None).awaitTermination(300)
    got = {r.sensor_id: r.avg_value for r in table.read(spark).collect()}
    assert got == {"a": 7.0, "b": 9.5, "c": 9.5, "d": 9.5, "e": 9.5}


def test_drift_job_publishes_per_batch(spark, folder):
    src = f"{folder}/in"
    feed(src, 0, [{"ts": float(i), "feature": (i * 37 % 100) / 100, "pred": 0.1, "actual": 0.1} for i in range(60)])
    feed(src, 1, [{"ts": float(i), "feature": 3 + (i * 37 % 100) / 100, "pred": 9.0, "actual": 9.0} for i in range(60, 120)])
    log = spark.readStream.schema(schemas.PREDICTION_LOG).option("maxFilesPerTrigger", 1).json(src)
    jobs.run_drift_job(log, f"{folder}/tails", f"{folder}/metrics", f"{folder}/ck", trigger=None).awaitTermination(300)
    got = spark.read.parquet(f"{folder}/metrics/*").orderBy("data_points").collect()
    assert [(r.data_points, r.drift_flag) for r in got] == [(60, 0.0), (120, 1.0)]


def test_request_kpis_stream_equals_batch(spark, folder, sf):
    src = f"{folder}/in"
    rows = [(i, "v2" if i % 5 == 0 else "v1", "503" if i % 11 == 0 else "200", float(i % 300)) for i in range(0, 1200, 2)]
    for n in range(4):
        feed(src, n, [{"ts": f"2024-01-01T00:{t // 60:02d}:{t % 60:02d}Z", "version": v, "status": s, "latency_ms": x}
                      for t, v, s, x in rows[n * 150:(n + 1) * 150]])
    feed(src, 9, [{"ts": "2024-01-01T09:00:00Z", "version": "v9", "status": "200", "latency_ms": 1.0}])
    bounds = [10, 100, 250]
    stream = spark.readStream.schema(schemas.REQUEST_LOG).option("maxFilesPerTrigger", 1).json(src)
    jobs.run_request_job(stream, f"{folder}/panes", f"{folder}/ck", ["version"], bounds, trigger=None).awaitTermination(300)
    panes = spark.read.parquet(f"{folder}/panes")
    got = me.kpis_from_panes(panes, ["version"], bounds)
    batch = spark.read.schema(schemas.REQUEST_LOG).json(src).where("version <> 'v9'")
    want = me.request_kpis(batch, ["version"], "ts", "status", "latency_ms", bounds)
    assert got.count() > 50
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_console_sink(spark, folder):
    src = f"{folder}/in"
    feed(src, 0, ramp("a", 0, 70) + [reading("a", 500, 1.0)])
    stream = message_stream(spark, "files", path=src)
    jobs.run_feature_job(stream, "", f"{folder}/ck", sink="console", trigger=None).awaitTermination(300)
    with pytest.raises(ValueError):
        jobs.run_feature_job(message_stream(spark, "files", path=src), "", f"{folder}/ck2", sink="pigeon")


def test_state_is_salted_not_collected(spark):
    df = spark.createDataFrame([("a", 0, 5.0)], schemas.SENSOR_READING)
    plan = se.window_features(se.event_time(df))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan


def test_rocksdb_state(spark, folder):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.use_rocksdb(spark)
    try:
        src = f"{folder}/in"
        feed(src, 0, ramp("a", 0, 60) + [reading("a", 500, 1.0)])
        stream = message_stream(spark, "files", path=src)
        jobs.run_feature_job(stream, f"{folder}/out", f"{folder}/ck", trigger=None).awaitTermination(300)
        assert [m["features"]["count"] for m in sent(spark, f"{folder}/out")] == [60]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
