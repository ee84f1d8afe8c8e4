import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opspark.sources import readers as rd, schemas, sinks as sk


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_prediction_log_drops_the_stray_header(spark, folder):
    path = put(folder, "log.csv", "ts,feature,pred,actual\n1.5,0.1,0.2,0.3\n2.5,0.4,0.5,0.6\n")
    assert [r.ts for r in rd.read_prediction_log(spark, path).orderBy("ts").collect()] == [1.5, 2.5]


def test_feature_history_times(spark, folder):
    path = put(folder, "d.csv", "driver_id,conv_rate,acc_rate,avg_daily_trips,event_timestamp\n1001,0.5,0.6,10,2021-08-12T10:00:00Z\n")
    row = rd.read_feature_history(spark, path).first()
    assert row.event_timestamp == datetime(2021, 8, 12, 10) and row.driver_id == 1001


def test_cost_sheet_without_the_summary_line(spark, folder):
    path = put(folder, "c.csv", "Scenario,MonthlyHours,GPUType,CostPerHourUSD,MonthlyCostUSD\nAlwaysOn,720,g,0.752,541.44\nSavings,,,88.89%\n")
    assert [r.Scenario for r in rd.read_cost_sheet(spark, path).collect()] == ["AlwaysOn"]


def test_folder_discovery(spark, folder):
    with pytest.raises(FileNotFoundError):
        rd.read_folder(spark, folder)
    spark.range(3).write.parquet(f"{folder}/x/a.parquet")
    spark.range(4).write.parquet(f"{folder}/x/b.parquet")
    assert rd.read_folder(spark, f"{folder}/x/a.parquet").count() == 3
    assert rd.read_folder(spark, f"{folder}/x").count() == 7
    put(f"{folder}/y", "a.csv", "id,value\n1,10\n2,20\n")
    put(f"{folder}/y", "b.csv", "id,value\n3,30\n")
    assert rd.read_folder(spark, f"{folder}/y").count() == 3


def test_latest_batch(spark, folder):
    assert rd.read_latest_batch(spark, folder) is None
    for i in (1, 3, 2):
        spark.range(i).write.parquet(f"{folder}/batch_{i}.parquet")
    assert rd.read_latest_batch(spark, folder).count() == 3


def test_features_and_target_join(spark, folder):
    spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, x double").write.parquet(f"{folder}/x")
    spark.createDataFrame([(2, 1), (1, 0)], "id int, y int").write.parquet(f"{folder}/y")
    assert {(r.id, r.y) for r in rd.read_with_target(spark, f"{folder}/x", f"{folder}/y", "id").collect()} == {(1, 0), (2, 1)}


def test_report_with_missing_totals(spark, folder):
    path = put(folder, "r.json", json.dumps({"Totals": {"total_pass": 9}, "Controls": [
        {"checks": [{"id": "1.2", "text": "b", "state": "FAIL", "scored": True}, {"id": "1.1", "text": "a", "state": "FAIL", "scored": False}]}]}, indent=1))
    report = rd.read_report(spark, path)
    assert tuple(report.first())[:4] == (9, 0, 0, 0)
    from opspark.operators.policy import critical_failures

    assert [r.line for r in critical_failures(report).collect()] == ["- [1.2] b"]


def test_readings_and_dead_letters(spark):
    good = '{"sensor_id": "s", "timestamp": 1000, "value": 2.5}'
    rows = [good, "oops", '{"sensor_id": "s", "value": 1}', '{"sensor_id": "s", "timestamp": "x", "value": 1}']
    parsed = rd.parse_readings(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert [tuple(r) for r in rd.accepted(parsed).collect()] == [("s", 1000, 2.5)]
    assert {r.message for r in rd.rejected(parsed).collect()} == set(rows[1:])


def test_history_append_is_partitioned_by_date(spark, folder):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 5)), ("b", datetime(2024, 1, 2))], "k string, event_timestamp timestamp")
    sk.append_history(df, f"{folder}/h", "event_timestamp")
    sk.append_history(df, f"{folder}/h", "event_timestamp")
    assert spark.read.parquet(f"{folder}/h").count() == 4
    assert {d for d in os.listdir(f"{folder}/h") if d.startswith("event_date")} == {"event_date=2024-01-01", "event_date=2024-01-02"}


def test_evidence_layout(spark, folder):
    df = spark.createDataFrame([("2024-03-05T01:02:03Z", "run7")], "timestamp string, run_id string")
    sk.write_evidence(df, f"{folder}/e")
    assert os.path.isdir(f"{folder}/e/year=2024/month=03/day=05/run=run7")


def test_metrics_document(spark, folder):
    table = sk.metrics_table(spark, {"rows": 3, "missing": {"x": 0.5}, "flags": ["a"]})
    sk.write_metrics(table, f"{folder}/m")
    got = {r.metric: json.loads(r.value) for r in spark.read.json(f"{folder}/m").collect()}
    assert got == {"rows": 3, "missing.x": 0.5, "flags": ["a"]}


def test_latest_table_is_idempotent(spark, folder):
    t = sk.LatestTable(f"{folder}/t", ["k"], "ts")
    one = spark.createDataFrame([("a", datetime(2024, 1, 1), 1), ("a", datetime(2024, 1, 2), 2)], "k string, ts timestamp, v int")
    two = spark.createDataFrame([("a", datetime(2023, 1, 1), 9), ("b", datetime(2024, 1, 1), 3)], "k string, ts timestamp, v int")
    assert t.read(spark) is None
    t.apply(one.limit(0), 0)
    assert t.read(spark) is None
    t.apply(one, 1)
    t.apply(two, 2)
    t.apply(one.withColumn("v", F.lit(77)), 2)  # a replay of batch 2 changes nothing
    assert {r.k: r.v for r in t.read(spark).collect()} == {"a": 2, "b": 3}


def test_latest_table_ignores_a_half_written_batch(spark, folder):
    t = sk.LatestTable(f"{folder}/t", ["k"], "ts")
    t.apply(spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "k string, ts timestamp, v int"), 1)
    # a writer lost after its data and before its manifest, and one lost while writing the manifest
    two = spark.createDataFrame([("a", datetime(2024, 1, 2), 2)], "k string, ts timestamp, v int")
    two.write.parquet(f"{folder}/t/data/batch=000000000002/part=0")
    open(f"{folder}/t/manifest/.000000000002.tmp", "w").write("{")
    assert [r.v for r in t.read(spark).collect()] == [1]
    t.apply(two, 2)
    assert [r.v for r in t.read(spark).collect()] == [2]


def test_latest_table_writes_only_the_parts_of_a_batch(spark, folder):
    t = sk.LatestTable(f"{folder}/t", ["k", "region"], "ts", parts=16)
    schema = "k long, region string, ts timestamp, v double, m map<string,decimal(5,2)>"
    many = spark.range(2000).selectExpr("id AS k", "if(id % 7 = 0, NULL, 'r') AS region", "timestamp '2024-01-01' AS ts", "id * 0.5 AS v", "map('a', cast(1 AS decimal(5,2))) AS m")
    t.apply(many, 5)
    first = t.manifest(spark, 5)
    assert len(first["parts"]) == 16 and set(first["parts"].values()) == {5}

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{folder}/t/data") for f in names if f.endswith(".parquet")}

    before = files()
    t.apply(spark.createDataFrame([(11, "r", datetime(2024, 2, 1), 99.0, None)], schema), 6)
    second = t.manifest(spark, 6)
    changed = [p for p in second["parts"] if second["parts"][p] != first["parts"][p]]
    assert len(changed) == 1 and second["parts"][changed[0]] == 6
    assert {f: n for f, n in files().items() if f in before} == before and len(files()) > len(before)
    got = {(r.k, r.region): r.v for r in t.read(spark).collect()}
    assert len(got) == 2000 and got[(11, "r")] == 99.0 and got[(12, "r")] == 6.0 and got[(7, None)] == 3.5
    # a third batch on the same part: the first batch's copy of that part is named by no kept manifest
    t.apply(spark.createDataFrame([(11, "r", datetime(2024, 3, 1), 100.0, None)], schema), 7)
    assert t.manifests(spark) == [6, 7] and not os.path.exists(f"{folder}/t/data/batch=000000000005/part={changed[0]}")
    assert len(os.listdir(f"{folder}/t/data/batch=000000000005")) >= 15
    assert t.read(spark).where("k = 11").first().v == 100.0 and t.read(spark).count() == 2000


def test_pushdown_and_pruning(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").where("o_totalprice > 1000").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "o_custkey" not in plan


def test_schemas_are_complete():
    assert schemas.WINDOW_FEATURES["features"].dataType.fieldNames() == [
        "avg_value", "min_value", "max_value", "std_dev", "count", "anomaly_count", "anomaly_rate"]


def test_unknown_message_source(spark):
    with pytest.raises(ValueError):
        rd.message_stream(spark, "carrier pigeon")


def test_cuts_are_written_to_the_shared_folder(spark):
    from opspark.session import cut_lineage, shared_folder

    out = cut_lineage(spark.range(5))
    assert out.count() == 5 and all(shared_folder(spark) in f for f in out.inputFiles())
    assert shared_folder(spark) == shared_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or shared_folder(spark).startswith(base.rstrip("/") + "/")


def test_a_session_without_settings_cuts_lineage_and_leaves_nothing(folder):
    """A plain local session, no configuration folder: tables are cut, and their folder goes with the application."""
    import subprocess
    import sys

    os.makedirs(f"{folder}/conf")
    code = ("from pyspark.sql import SparkSession\n"
            "from opspark.session import cut_lineage, shared_folder\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "print('rows', cut_lineage(spark.range(5)).count(), shared_folder(spark))\n"
            "spark.stop()\n")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_SUBMIT"))}
    env |= {"SPARK_CONF_DIR": f"{folder}/conf", "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "TMPDIR": folder}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    line = next(x for x in done.stdout.splitlines() if x.startswith("rows 5 "))
    assert not os.path.exists(line.split()[2])
