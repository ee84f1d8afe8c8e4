"""Queries that write, read back and compare: fitted flows, splits, metrics, evidence, reports, keyed tables, late rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from opspark.operators import features as fe, models as mo, policy as po, prepare as pr
from opspark.plans.feature_queries import rounded
from opspark.plans.flow_queries import local_state, scratch
from opspark.plans.registry import query, table
from opspark.plans.table_queries import SPLIT_SQL
from opspark.plans.workflows import DEFAULTS, apply_prepared, fit_features, load_latest_flow, prepare_table
from opspark.sources import readers as rd, schemas, sinks as sk
from opspark.streaming import jobs

# -- fitted flows: saved, reloaded, applied to the parts they were not fitted on ----------------------------------------

#: Rows of orders with three separate groups, a category that the training part does not know, and a split.
FLOW_SQL = """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '-42'), o_orderkey) AS r,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
s AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1024 ELSE 4096 END AS place, (o_custkey % 64) / 64.0 AS small, (o_totalprice > 150000)::INT AS target,
   CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' WHEN r <= floor(n * 0.2 + 0.5) + floor(n * 0.1 + 0.5) THEN 'validation' ELSE 'train' END AS part, o_orderpriority FROM p),
t AS (SELECT o_orderkey, part, target, place, place + small AS x, place - 2 * small AS y,
   CASE WHEN part <> 'train' AND o_orderkey % 50 = 0 THEN 'new' ELSE o_orderpriority END AS p FROM s),
u AS (SELECT *, x * x AS xx, x * y AS xy, y * y AS yy FROM t)"""


def _flow_parts(spark, sf):
    o = table(spark, sf, "orders")
    parts = o.join(pr.split(o.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus").select("o_orderkey", "split"), "o_orderkey")
    place = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1024).otherwise(4096)
    small = (F.col("o_custkey") % 64) / 64.0
    unknown = (F.col("split") != "train") & (F.col("o_orderkey") % 50 == 0)
    return parts.select(
        "o_orderkey", F.col("split").alias("part"), (place + small).alias("x"), (place - 2 * small).alias("y"),
        F.when(unknown, "new").otherwise(F.col("o_orderpriority")).alias("p"), (F.col("o_totalprice") > 150000).cast("int").alias("target"))


def _stored_flow_sql():
    distance = " + ".join(f"(u.{c} - c{{i}}.{c}) * (u.{c} - c{{i}}.{c})" for c in ("x", "y", "xx", "xy", "yy"))
    distances = ", ".join(f"sqrt({distance.format(i=i)}) AS d{i}" for i in range(3))
    centres = ", ".join(f"(SELECT * FROM c WHERE place = {p}) c{i}" for i, p in enumerate((0, 1024, 4096)))
    return FLOW_SQL + f""",
    c AS (SELECT place, avg(x) AS x, avg(y) AS y, avg(xx) AS xx, avg(xy) AS xy, avg(yy) AS yy FROM u WHERE part = 'train' GROUP BY 1),
    m AS (SELECT p AS v, avg(target) AS m FROM u WHERE part = 'train' GROUP BY 1),
    d AS (SELECT u.*, {distances} FROM u, {centres} WHERE part <> 'train')
    SELECT o_orderkey, part, target, x, y, xx AS "x^2", xy AS "x y", yy AS "y^2", round(d0, 2) AS distance_to_cluster_0, round(d1, 2) AS distance_to_cluster_1,
      round(d2, 2) AS distance_to_cluster_2, CASE place WHEN 0 THEN 0 WHEN 1024 THEN 1 ELSE 2 END AS cluster,
      round(coalesce(m, (SELECT avg(m) FROM m)), 6) AS p FROM d LEFT JOIN m ON v = p"""


@query("stored_flow_on_other_parts", "M17 S13 M3 M4 M5 M8 A15", _stored_flow_sql())
def _(spark, sf):
    path, parts = scratch(spark), _flow_parts(spark, sf)
    fitted = fit_features(parts.where("part = 'train'").drop("part", "o_orderkey"), engineering={"n_clusters": 3}, selection={"method": "anova", "variance_threshold": 0.0})
    fitted.save(spark, path, datetime(2024, 1, 1))
    flow, _ = load_latest_flow(spark, path)
    out = flow.apply(parts.where("part <> 'train'"), keep=["o_orderkey", "part"])
    return rounded(rounded(out, *[f"distance_to_cluster_{i}" for i in range(3)], places=2), "p", places=6)


@query("stored_label_encoder", "S13 M7 J3", """
WITH c AS (SELECT p_name AS v, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 10))
SELECT p_partkey, coalesce(code, -1)::INT AS p_name, p_size FROM part LEFT JOIN c ON v = p_name""")
def _(spark, sf):
    path = scratch(spark)
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    fit_features(df.where("p_size > 10"), "target", {"polynomial_degree": 1, "create_clusters": False, "encoding_method": "label"}, {"method": "none"}).save(
        spark, path, datetime(2024, 1, 1))
    return load_latest_flow(spark, path)[0].apply(df)


@query("one_hot_sparse_names", "M6 S13", """
WITH c AS (SELECT p_name AS v, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part WHERE p_size > 10))
SELECT p_partkey, code::INT AS place, 1.0::DOUBLE AS value FROM part JOIN c ON v = p_name""")
def _(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    known = fe.categories(df.where("p_size > 10"), "p_name")
    return fe.sparse_rows(fe.sparse_one_hot(df, "p_name", known, known.count()), "p_partkey", "p_name_hot")


@query("stored_preparation", "S13 P8 A5 A16 M1", """
WITH f AS (SELECT * FROM lineitem WHERE l_linenumber < 4), b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS z FROM f),
w AS (SELECT * FROM f, b WHERE l_extendedprice BETWEEN a - 1.5 * (z - a) AND z + 1.5 * (z - a)),
s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM w)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / s, 6) AS price FROM lineitem, b, s
WHERE l_linenumber >= 4 AND l_extendedprice BETWEEN a - 1.5 * (z - a) AND z + 1.5 * (z - a)""")
def _(spark, sf):
    from opspark.sources.state import load_state, save_state

    path = scratch(spark)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    done = prepare_table(li.where("l_linenumber < 4").select("l_orderkey", "price"), "l_orderkey", config=DEFAULTS["prepare"] | {"handle_missing": "mean"})
    save_state(spark, done.state, path)
    return rounded(apply_prepared(li.where("l_linenumber >= 4"), load_state(spark, path)), "price", places=6)


@query("reloaded_model_agrees", "M24 S14", "SELECT count(*) AS rows, true AS complete, true AS agrees FROM orders")
def _(spark, sf):
    path = scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    cols = ["o_totalprice", "month"]
    model = mo.fit_forest(o, cols, trees=5, max_depth=4)
    sk.save_version(model, spark, path)
    both = [mo.score_table(m, o, cols, ["o_orderkey"]) for m in (model, sk.load_latest(spark, path))]
    return mo.agreement(*both, "o_orderkey").select("rows", "complete", "agrees")


# -- files ---------------------------------------------------------------------------------------------------------------

@query("splits_read_back", "S11 U4", f"""
WITH s AS ({SPLIT_SQL.format(part="")})
SELECT split AS part, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total FROM s JOIN orders USING (o_orderkey) GROUP BY 1""")
def _(spark, sf):
    path = scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    sk.write_splits(pr.split(o, "o_orderkey"), path)
    parts = None
    for name in ("train", "validation", "test"):  # each part is a folder of its own
        one = spark.read.parquet(f"{path}/split={name}").groupBy(F.lit(name).alias("part")).agg(
            F.count("*").alias("rows"), F.countDistinct("o_orderkey").alias("keys"), F.sum("o_totalprice").alias("total"))
        parts = one if parts is None else parts.unionByName(one)
    return rounded(parts, "total", places=2)


@query("metrics_document", "S12", """
SELECT 'rows' AS metric, count(*)::VARCHAR AS value FROM lineitem
UNION ALL SELECT 'by_flag.' || l_returnflag, count(*)::VARCHAR FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'status.ok', 'true' FROM (SELECT count(*) FROM lineitem)""")
def _(spark, sf):
    path = scratch(spark)
    flags = {r[0]: r[1] for r in table(spark, sf, "lineitem").groupBy("l_returnflag").count().collect()}
    sk.write_metrics(sk.metrics_table(spark, {"rows": sum(flags.values()), "by_flag": flags, "status": {"ok": True}}, datetime(2024, 1, 1)), path)
    return spark.read.json(path).select("metric", "value")


@query("evidence_folders", "S17 X4 D9", """
SELECT strftime(ts, 'year=%Y/month=%m/day=%d/run=') || (user_id % 3) AS folder, count(*) AS records, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def _(spark, sf):
    path = scratch(spark)
    e = table(spark, sf, "events")
    sk.write_evidence(e.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), (F.col("user_id") % 3).cast("string").alias("run_id"), "value"), path)
    back = spark.read.json(path).withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), "(year=[^/]*/month=[^/]*/day=[^/]*/run=[^/]*)/", 1))
    return rounded(back.groupBy("folder").agg(F.count("*").alias("records"), F.sum("value").alias("total")))


REPORT_SQL = """
WITH c AS (SELECT p_partkey // 40 AS report, lpad(p_partkey::VARCHAR, 9, '0') AS id, p_name AS text, p_size % 3 = 0 AS fails, p_size % 2 = 0 AS scored FROM part)"""


def _reports(spark, sf):
    """Nested reports of at most 40 checks, written as JSON and read back; every third has no totals."""
    path = scratch(spark)
    fails = F.col("p_size") % 3 == 0
    check = F.struct(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("id"), F.col("p_name").alias("text"),
                     F.when(fails, "FAIL").otherwise("PASS").alias("state"), (F.col("p_size") % 2 == 0).alias("scored"))
    grouped = table(spark, sf, "part").groupBy(F.floor(F.col("p_partkey") / 40).alias("report")).agg(
        F.count_if(~fails).alias("ok"), F.count_if(fails).alias("bad"), F.collect_list(check).alias("checks"))
    totals = F.when(F.col("report") % 3 != 0, F.struct(F.col("ok").alias("total_pass"), F.col("bad").alias("total_fail")))
    grouped.select(totals.alias("Totals"), F.array(F.struct("checks")).alias("Controls")).write.option("maxRecordsPerFile", 1).json(path)
    return rd.read_report(spark, path)


@query("nested_report_score", "S18 A36 D8", REPORT_SQL + """,
t AS (SELECT count(*) FILTER (NOT fails AND report % 3 <> 0) AS p, count(*) FILTER (fails AND report % 3 <> 0) AS f FROM c), s AS (SELECT p, f, round(p / (p + f) * 100, 1) AS s FROM t)
SELECT p AS total_pass, f AS total_fail, 0::BIGINT AS total_warn, 0::BIGINT AS total_info, p + f AS total_checks, s AS compliance_score,
  CASE WHEN s >= 90 THEN 'COMPLIANT' WHEN s >= 70 THEN 'PARTIALLY COMPLIANT' ELSE 'NON-COMPLIANT' END AS status FROM s""")
def _(spark, sf):
    return po.compliance_score(_reports(spark, sf))


@query("nested_report_failures", "S18 T2 D8", REPORT_SQL + """
SELECT id, '- [' || id || '] ' || text AS line FROM c WHERE fails AND scored ORDER BY id, text LIMIT 10""")
def _(spark, sf):
    return po.critical_failures(_reports(spark, sf))


# -- keyed table and streams ----------------------------------------------------------------------------------------------

@query("online_table_of_batches", "S16 R9 W2", """
WITH e AS (SELECT * FROM events WHERE event_type <> 'error' OR user_id % 7 = 0), m AS (SELECT user_id, max(ts) AS ts FROM e GROUP BY 1)
SELECT e.user_id, epoch_us(e.ts)::BIGINT AS at_us, e.value FROM e JOIN m ON m.user_id = e.user_id AND m.ts = e.ts""")
def _(spark, sf):
    """Batches by kind, one of them for few keys; a replay and an older row change nothing."""
    kept = sk.LatestTable(scratch(spark), ["user_id"], "ts", parts=16)
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")
    for number, kind in enumerate(("click", "purchase", "signup", "view")):
        kept.apply(e.where(F.col("event_type") == kind).drop("event_type"), number)
    kept.apply(e.where("event_type = 'error' AND user_id % 7 = 0").drop("event_type"), 4)
    kept.apply(e.where("event_type = 'error'").drop("event_type"), 4)
    kept.apply(e.where("event_type = 'click' AND day(ts) < 5").drop("event_type"), 5)
    return kept.read(spark).select("user_id", F.unix_micros("ts").alias("at_us"), "value")


@query("stream_late_rows", "R5 R8 R2", """
WITH r AS (SELECT event_type AS sensor_id, ts, value, 1 AS copies FROM events
  UNION ALL SELECT event_type, ts, value + 1000, 1 FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-25' AND event_id % 3 = 0),
w AS (SELECT sensor_id, time_bucket(INTERVAL 1 DAY, ts) AS w, value FROM r)
SELECT sensor_id, epoch_ms(w)::BIGINT AS window_start, count(*) AS count, round(max(value), 2) AS max_value FROM w
WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events) GROUP BY sensor_id, w""")
def _(spark, sf):
    """Three stages with a restart after each. The third brings copies of rows of three days: two are behind the
    watermark and dropped, those of the day that is still open count."""
    path = scratch(spark)
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")

    def day(number):
        return F.col("ts") >= F.lit(f"2024-01-{number:02d}").cast("timestamp")

    def stage(df):
        return df.select(F.to_json(F.struct(F.col("event_type").alias("sensor_id"), F.unix_millis("ts").alias("timestamp"), "value")).alias("value"))

    late = e.where((day(5) & ~day(6) | day(21) & ~day(22) | day(24) & ~day(25)) & (F.col("event_id") % 3 == 0)).withColumn("value", F.col("value") + 1000)
    stages = [stage(e.where(~day(20))), stage(e.where(day(20) & ~day(25))), stage(late.unionByName(e.where(day(25))))]
    with local_state(spark):
        jobs.run_stages(stages, f"{path}/in", lambda stream: jobs.run_feature_job(stream, f"{path}/out", f"{path}/state", width="1 day", trigger=None))
    sent = spark.read.text(f"{path}/out").select(F.from_json("value", schemas.WINDOW_FEATURES).alias("m"))
    return sent.select("m.sensor_id", "m.window_start", "m.features.count", "m.features.max_value")


@query("stream_to_console", "S10", """
WITH w AS (SELECT DISTINCT event_type, time_bucket(INTERVAL 1 DAY, ts) AS w FROM events)
SELECT count(*) AS rows_printed FROM w WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)""")
def _(spark, sf):
    """The rows that the console sink reports to have printed."""
    path = scratch(spark)
    e = table(spark, sf, "events")
    message = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "value")).alias("value")
    e.select(message).write.text(f"{path}/in")
    with local_state(spark):
        job = jobs.run_feature_job(rd.message_stream(spark, "files", path=f"{path}/in"), "", f"{path}/state", sink="console", width="1 day", trigger=None)
        job.awaitTermination()
    printed = sum(max(0, p.sink.numOutputRows) for p in job.recentProgress)
    return spark.createDataFrame([(printed,)], "rows_printed long")
