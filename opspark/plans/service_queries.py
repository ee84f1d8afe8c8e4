"""Queries on feature tables, service metrics, gates, costs and window features."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opspark.operators import gates as ga, metrics as me, store as st
from opspark.plans.feature_queries import rounded
from opspark.plans.registry import query, table
from opspark.plans.table_queries import tall
from opspark.streaming import sensor as se

# -- request log: events with a status and a version by rule ------------------

REQUEST_SQL = """
  SELECT event_id, epoch_us(ts) / 1000000.0 AS tsec, ts, user_id, event_type AS service,
    CASE WHEN user_id % 10 = 0 THEN 'v2' ELSE 'v1' END AS version,
    CASE WHEN event_type = 'error' THEN '503' WHEN event_type = 'signup' THEN '201' ELSE '200' END AS status,
    value AS latency_ms FROM events"""


def requests(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", kind.alias("service"),
        F.when(F.col("user_id") % 10 == 0, "v2").otherwise("v1").alias("version"),
        F.when(kind == "error", "503").when(kind == "signup", "201").otherwise("200").alias("status"),
        F.col("value").alias("latency_ms"))


# -- feature tables ------------------------------------------------------------

@query("latest_features", "W2 S16", """
SELECT user_id, epoch_us(max(ts))::BIGINT AS at_us, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type
FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20' GROUP BY 1""")
def _(spark, sf):
    out = st.latest(table(spark, sf, "events"), ["user_id"], "ts", ["value", "event_type"],
                    datetime(2024, 1, 5), datetime(2024, 1, 20))
    return out.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), "value", "event_type")


@query("incremental_latest_merge", "W2 S16 R9", """
SELECT user_id, epoch_us(max(ts))::BIGINT AS at_us, arg_max(value, ts) AS value FROM events GROUP BY 1""")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "value")
    mid = datetime(2024, 1, 15)
    old = st.latest(e, ["user_id"], "ts", ["value"], until=mid)
    new = st.latest(e, ["user_id"], "ts", ["value"], after=mid)
    out = st.merge_latest(old, new, ["user_id"], "ts")
    return out.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), "value")


LOOKUP_SQL = """
WITH f AS (SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY 1),
a AS (SELECT DISTINCT c_custkey AS user_id FROM customer)"""


@query("online_lookup", "J1", LOOKUP_SQL + " SELECT a.user_id, f.value FROM a LEFT JOIN f USING (user_id)")
def _(spark, sf):
    f = st.latest(table(spark, sf, "events"), ["user_id"], "ts", ["value"])
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return st.online_lookup(asked, f, ["user_id"], ["value"])


@query("online_lookup_with_ttl", "J1", LOOKUP_SQL + """
SELECT a.user_id, CASE WHEN TIMESTAMP '2024-01-31' - f.ts <= INTERVAL 12 HOUR THEN f.value END AS value FROM a LEFT JOIN f USING (user_id)""")
def _(spark, sf):
    f = st.latest(table(spark, sf, "events"), ["user_id"], "ts", ["value"])
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return st.online_lookup(asked, f, ["user_id"], ["value"], "ts", datetime(2024, 1, 31), timedelta(hours=12))


@query("point_in_time_join", "J2", """
WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT user_id, ts, value, event_id AS view_id FROM events WHERE event_type = 'view')
SELECT e.event_id, CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN f.value END AS value,
  CASE WHEN e.ts - f.ts <= INTERVAL 1 DAY THEN f.view_id END AS view_id
FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.ts >= f.ts""")
def _(spark, sf):
    e = table(spark, sf, "events")
    spine = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    history = e.where("event_type = 'view'").select("user_id", "ts", "value", F.col("event_id").alias("view_id"))
    out = st.point_in_time(spine, history, ["user_id"], "ts", "ts", ["value", "view_id"], timedelta(days=1))
    return out.select("event_id", "value", "view_id")


# -- counters and rates ---------------------------------------------------------

COUNTER_SQL = f"""
  SELECT service, version, status, tsec, event_id, (row_number() OVER (PARTITION BY service, version, status ORDER BY tsec, event_id) % 97)::DOUBLE
    AS v FROM ({REQUEST_SQL})"""


def counters(spark, sf):
    """Counter samples: the running request count of a series, wrapping after 97."""
    from opspark.operators.ranking import running_totals

    r = requests(spark, sf).withColumn("one", F.lit(1)).withColumn("tsec", st.seconds(F.col("ts")))
    day = F.floor(F.col("tsec") / F.lit(86400.0))
    run = running_totals(r, ["service", "version", "status"], "tsec", ["one"], bucket=day, tie_break=["event_id"])
    return run.select("service", "version", "status", "ts", "event_id", F.pmod("cum_one", F.lit(97)).cast("double").alias("v"))


SERIES = ["service", "version", "status"]


def rate_sql(span: int, step: int) -> str:
    return f"""c AS ({COUNTER_SQL}),
w AS (SELECT *, (floor(tsec / {step}) + i) * {step} AS eval_at FROM c, range(1, {span // step + 1}) r(i)),
l AS (SELECT *, lag(v) OVER (PARTITION BY service, version, status, eval_at ORDER BY tsec, event_id) AS p FROM w),
r AS (SELECT service, version, status, eval_at::BIGINT AS eval_at, count(*) AS samples,
  sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS increase,
  CASE WHEN count(*) >= 2 THEN sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) / nullif(max(tsec) - min(tsec), 0) END AS rate
  FROM l GROUP BY 1, 2, 3, 4)"""


@query("counter_rate_tumbling", "A32 W5", f"WITH {rate_sql(21600, 21600)} SELECT * REPLACE (round(rate, 6) AS rate) FROM r")
def _(spark, sf):
    return rounded(me.counter_rate(counters(spark, sf), SERIES, "ts", "v", 21600, tie_break=["event_id"]), "rate", places=6)


@query("counter_rate_sliding", "A32 W5 W6", f"WITH {rate_sql(14400, 3600)} SELECT * REPLACE (round(rate, 6) AS rate) FROM r")
def _(spark, sf):
    return rounded(me.counter_rate(counters(spark, sf), SERIES, "ts", "v", 14400, 3600, ["event_id"]), "rate", places=6)


def hourly(spark, sf):
    return me.counter_rate(counters(spark, sf), SERIES, "ts", "v", 14400, 3600, ["event_id"])


@query("success_ratio_by_version", "J4 P11 A33", f"""
WITH {rate_sql(14400, 3600)}, a AS (SELECT version, eval_at, sum(rate) AS t FROM r WHERE regexp_full_match(status, '2..') GROUP BY 1, 2 HAVING count(*) > 0),
b AS (SELECT version, eval_at, sum(rate) AS b FROM r GROUP BY 1, 2)
SELECT version, eval_at, round(t / nullif(b, 0), 6) AS ratio FROM a JOIN b USING (version, eval_at) WHERE t IS NOT NULL""")
def _(spark, sf):
    hit = me.matches(F.col("status"), "=~", "2..")
    return rounded(me.vector_ratio(hourly(spark, sf), ["version", "eval_at"], hit, F.col("rate")), places=6)


@query("label_matchers", "P11", f"""
SELECT version, count(*) FILTER (status = '200') AS eq, count(*) FILTER (status <> '200') AS ne,
  count(*) FILTER (regexp_full_match(status, '2..')) AS re, count(*) FILTER (NOT regexp_full_match(status, '2..|5')) AS nre
FROM ({REQUEST_SQL}) GROUP BY 1""")
def _(spark, sf):
    s = F.col("status")
    return requests(spark, sf).groupBy("version").agg(
        F.count_if(me.matches(s, "=", "200")).alias("eq"), F.count_if(me.matches(s, "!=", "200")).alias("ne"),
        F.count_if(me.matches(s, "=~", "2..")).alias("re"), F.count_if(me.matches(s, "!~", "2..|5")).alias("nre"))


@query("sum_and_average_by_labels", "A33", f"""
WITH {rate_sql(21600, 21600)} SELECT version, round(sum(rate), 6) AS total, round(avg(rate), 6) AS average FROM r GROUP BY 1""")
def _(spark, sf):
    r = me.counter_rate(counters(spark, sf), SERIES, "ts", "v", 21600, tie_break=["event_id"])
    return rounded(me.sum_by(r, ["version"], "rate").join(me.average_by(r, ["version"], "rate"), "version"), places=6)


BOUNDS = [1, 2, 5, 10, 25, 50, 100, 250]


@query("bucket_quantiles", "A34", f"""
WITH q AS ({REQUEST_SQL}), b AS (SELECT unnest([{', '.join(map(str, BOUNDS))}, 'inf'::DOUBLE]) AS le),
c AS (SELECT version, le, count(*) FILTER (latency_ms <= le) AS c FROM q, b GROUP BY 1, 2),
w AS (SELECT *, coalesce(lag(le) OVER (PARTITION BY version ORDER BY le), 0) AS f, coalesce(lag(c) OVER (PARTITION BY version ORDER BY le), 0) AS p,
   max(c) OVER (PARTITION BY version) AS n FROM c),
v AS (SELECT *, row_number() OVER (PARTITION BY version ORDER BY le) AS k FROM w WHERE c >= 0.95 * n)
SELECT version, round(CASE WHEN le = 'inf'::DOUBLE THEN f ELSE f + (le - f) * (0.95 * n - p) / (c - p) END, 4) AS quantile FROM v WHERE k = 1""")
def _(spark, sf):
    return rounded(me.bucket_quantile(me.bucket_counts(requests(spark, sf), ["version"], "latency_ms", BOUNDS), ["version"], 0.95))


@query("latency_percentiles", "A34", f"""
SELECT service, round(quantile_cont(latency_ms, 0.5), 4) AS p50, round(quantile_cont(latency_ms, 0.99), 4) AS p99 FROM ({REQUEST_SQL}) GROUP BY 1""")
def _(spark, sf):
    from opspark.operators.quantiles import grouped_quantiles

    tall = grouped_quantiles(requests(spark, sf), ["service"], {"latency_ms": F.col("latency_ms")}, [0.5, 0.99])
    at = {p: F.max(F.when(F.col("prob") == p, F.round("value", 4))) for p in (0.5, 0.99)}
    return tall.groupBy("service").agg(at[0.5].alias("p50"), at[0.99].alias("p99"))


@query("user_value_percentiles", "A34 A23", """
SELECT nullif(user_id % 50, 7) AS grp, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.9), 4) AS p90 FROM events GROUP BY 1""")
def _(spark, sf):
    """Brackets of more than 20 rows are cut again, as those of large tables are; the null group is a group."""
    from opspark.operators.quantiles import grouped_quantiles

    e = table(spark, sf, "events").select(F.nullif(F.col("user_id") % 50, F.lit(7)).alias("grp"), "value")
    tall = grouped_quantiles(e, ["grp"], {"value": F.col("value")}, [0.25, 0.9], limit=20)
    at = {p: F.max(F.when(F.col("prob") == p, F.round("value", 4))) for p in (0.25, 0.9)}
    return tall.groupBy("grp").agg(at[0.25].alias("p25"), at[0.9].alias("p90"))


@query("traffic_share", "A35", f"""
SELECT version, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ({REQUEST_SQL}) GROUP BY 1""")
def _(spark, sf):
    return rounded(me.share(requests(spark, sf).withColumn("one", F.lit(1)), "version", "one"), places=6)


def kpi_sql(step=3600, span=14400):
    le = ", ".join(f"sum((latency_ms <= {b})::INT) AS le{i}" for i, b in enumerate(BOUNDS))
    n = len(BOUNDS)
    cases = " ".join(
        f"WHEN le{i} >= 0.99::DOUBLE * n THEN {BOUNDS[i - 1] if i else 0} + {BOUNDS[i] - (BOUNDS[i - 1] if i else 0)} * "
        f"((0.99::DOUBLE * n - {f'le{i - 1}' if i else 0}) / (le{i} - {f'le{i - 1}' if i else 0}))" for i in range(n))
    return f"""q AS ({REQUEST_SQL}),
w AS (SELECT *, (floor(tsec / {step}) + i) * {step} AS eval_at FROM q, range(1, {span // step + 1}) r(i)),
s AS (SELECT version, eval_at::BIGINT AS eval_at, count(*) AS n, sum((status LIKE '2__')::INT) AS ok, sum((status LIKE '5__')::INT) AS bad, {le}
  FROM w GROUP BY 1, 2),
k AS (SELECT version, eval_at, n / {span}.0 AS request_rate, ok / n AS success_rate, bad / n AS error_rate,
  CASE {cases} ELSE {BOUNDS[-1]} END::DOUBLE AS latency_quantile FROM s)"""


def kpis(spark, sf):
    return me.request_kpis(requests(spark, sf), ["version"], "ts", "status", "latency_ms", BOUNDS, 3600, 14400)


@query("request_kpis", "R11 W6 A33 A34", f"""WITH {kpi_sql()} SELECT version, eval_at, round(request_rate, 6) AS request_rate,
  round(success_rate, 6) AS success_rate, round(error_rate, 6) AS error_rate, round(latency_quantile, 4) AS latency_quantile FROM k""")
def _(spark, sf):
    out = rounded(kpis(spark, sf), "request_rate", "success_rate", "error_rate", places=6)
    return rounded(out, "latency_quantile")


@query("sliding_sums", "W6", f"""
WITH q AS ({REQUEST_SQL}), w AS (SELECT *, (floor(tsec / 3600) + i) * 3600 AS eval_at FROM q, range(1, 7) r(i))
SELECT service, eval_at::BIGINT AS eval_at, count(*) AS requests, round(sum(latency_ms), 4) AS latency FROM w GROUP BY 1, 2""")
def _(spark, sf):
    out = me.sliding_sums(requests(spark, sf), ["service"], "ts",
                          {"requests": F.lit(1).cast("bigint"), "latency": F.col("latency_ms")}, 3600, 21600)
    return rounded(out)


@query("last_values", "W9", f"""
SELECT service, arg_max(latency_ms, ts) AS last_value FROM ({REQUEST_SQL}) WHERE version = 'v1' GROUP BY 1""")
def _(spark, sf):
    r = requests(spark, sf).withColumn("seen", F.when(F.col("version") == "v1", F.col("latency_ms")))
    return me.last_value(r, ["service"], "ts", "seen")


@query("success_tiers", "W10 X12", f"""
WITH {kpi_sql()}, z AS (SELECT version, eval_at, CASE WHEN request_rate > 0.003 THEN success_rate + 0.15 END AS r FROM k)
SELECT version, eval_at, CASE WHEN r IS NULL THEN 'N/A' WHEN r >= 0.99 THEN 'green' WHEN r >= 0.95 THEN 'yellow' ELSE 'red' END AS tier FROM z""")
def _(spark, sf):
    r = F.when(F.col("request_rate") > 0.003, F.col("success_rate") + 0.15)
    return kpis(spark, sf).select("version", "eval_at", me.tier(r).alias("tier"))


@query("threshold_alerts", "P14", f"WITH {kpi_sql()} SELECT version, eval_at, round(error_rate, 6) AS error_rate FROM k WHERE error_rate > 0.3")
def _(spark, sf):
    return rounded(me.above(kpis(spark, sf), "error_rate", 0.3).select("version", "eval_at", "error_rate"), places=6)


@query("error_rate_per_second", "A32 P14", f"""
WITH {rate_sql(14400, 3600)} SELECT version, eval_at, round(sum(rate), 6) AS errors_per_second FROM r WHERE status <> '200' GROUP BY 1, 2""")
def _(spark, sf):
    bad = hourly(spark, sf).where(me.matches(F.col("status"), "!=", "200"))
    return rounded(me.sum_by(bad, ["version", "eval_at"], "rate", "errors_per_second"), places=6)


@query("alert_states", "W3", f"""
WITH {kpi_sql()}, i AS (SELECT *, sum((NOT error_rate > 0.2)::INT) OVER (PARTITION BY version ORDER BY eval_at) AS g FROM k),
z AS (SELECT *, min(CASE WHEN error_rate > 0.2 THEN eval_at END) OVER (PARTITION BY version, g) AS since FROM i)
SELECT version, eval_at, CASE WHEN NOT error_rate > 0.2 THEN 'inactive' WHEN eval_at - since >= 7200 THEN 'firing' ELSE 'pending' END AS state FROM z""")
def _(spark, sf):
    out = ga.alert_states(kpis(spark, sf), ["version"], "eval_at", F.col("error_rate") > 0.2, 7200)
    return out.select("version", "eval_at", "state")


@query("canary_gate", "W4", f"""
WITH {kpi_sql()}, c AS (SELECT version, eval_at, CASE WHEN request_rate > 0.0002 THEN success_rate + 0.1 END AS r FROM k),
g AS (SELECT version, eval_at, count(r) OVER w AS n, sum((r < 0.95)::INT) OVER w AS f FROM c
  WINDOW w AS (PARTITION BY version ORDER BY eval_at ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT version, eval_at, CASE WHEN f > 0 THEN 'failed' WHEN n = 3 THEN 'successful' ELSE 'inconclusive' END AS verdict FROM g""")
def _(spark, sf):
    r = F.when(F.col("request_rate") > 0.0002, F.col("success_rate") + 0.1)
    out = ga.canary_gate(kpis(spark, sf).withColumn("r", r), ["version"], "eval_at", "r")
    return out.select("version", "eval_at", "verdict")


@query("analysis_gate", "R14", f"""
WITH {kpi_sql()} SELECT version, count(*) AS checks, count(*) FILTER (NOT (success_rate >= 0.6 AND latency_quantile <= 240)) AS failures,
 CASE WHEN count(*) FILTER (NOT (success_rate >= 0.6 AND latency_quantile <= 240)) <= 3 THEN 'promote' ELSE 'rollback' END AS decision FROM k GROUP BY 1""")
def _(spark, sf):
    return ga.analysis_gate(kpis(spark, sf), ["version"], "success_rate", "latency_quantile", 0.6, 240.0)


STAGE_SQL = f"""
SELECT version, service, stage, ok, CASE WHEN NOT coalesce(bool_and(ok) OVER (PARTITION BY version, service ORDER BY stage ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)
  THEN 'skipped' WHEN ok THEN 'promote' ELSE 'abort' END AS action FROM (
SELECT version, service, CASE WHEN day(ts) <= 10 THEN 10 WHEN day(ts) <= 20 THEN 50 ELSE 100 END AS stage, avg(latency_ms) <= 52 AS ok
FROM ({REQUEST_SQL}) GROUP BY 1, 2, 3)"""


@query("staged_rollout", "R13 W4", STAGE_SQL)
def _(spark, sf):
    day = F.dayofmonth("ts")
    stage = F.when(day <= 10, 10).when(day <= 20, 50).otherwise(100).alias("stage")
    per = requests(spark, sf).groupBy("version", "service", stage).agg((F.avg("latency_ms") <= 52).alias("ok"))
    return ga.staged_rollout(per, ["version", "service"], "stage", "ok")


@query("error_runs", "W7", f"""
WITH q AS (SELECT version, tsec, event_id, latency_ms > 40 AS bad FROM ({REQUEST_SQL})),
i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY version ORDER BY tsec, event_id) AS g FROM q)
SELECT version, count(*) AS run_length, min(tsec)::DOUBLE AS first_at, max(tsec)::DOUBLE AS last_at, (max(tsec) + 30)::DOUBLE AS ejected_until
FROM i WHERE bad GROUP BY version, g HAVING count(*) >= 5""")
def _(spark, sf):
    return ga.error_runs(requests(spark, sf), ["version"], "ts", F.col("latency_ms") > 40, ["event_id"])


@query("long_message_runs", "W7", """
WITH i AS (SELECT conv_id, turn, text, sum((length(text) <= 300)::INT) OVER (PARTITION BY conv_id ORDER BY turn, md5(text)) AS g FROM conversations)
SELECT conv_id, count(*) AS run_length FROM i WHERE length(text) > 300 GROUP BY conv_id, g HAVING count(*) >= 2""")
def _(spark, sf):
    c = table(spark, sf, "conversations").select(
        "conv_id", F.length("text").alias("n"), F.md5(F.col("text").cast("binary")).alias("d"), F.timestamp_seconds("turn").alias("tsec"))
    return ga.error_runs(c, ["conv_id"], "tsec", F.col("n") > 300, ["d"], min_run=2).select("conv_id", "run_length")


@query("weighted_traffic_split", "M25", """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'v2' WHEN ('0x' || substr(md5(user_id::VARCHAR || '-42'), 1, 7))::BIGINT % 100 < 10
  THEN 'v2' ELSE 'v1' END AS version FROM events""")
def _(spark, sf):
    header = F.when(F.col("event_type") == "signup", "v2")
    return table(spark, sf, "events").select("event_id", ga.traffic_split(F.col("user_id"), 10, header).alias("version"))


@query("user_sessions", "R12", """
WITH l AS (SELECT user_id, epoch_us(ts) / 1000000.0 AS tsec, lag(epoch_us(ts) / 1000000.0) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
s AS (SELECT *, sum(CASE WHEN tsec - p < 3600 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY tsec) AS session FROM l)
SELECT user_id, session::BIGINT AS session, min(tsec)::DOUBLE AS started_at, max(tsec)::DOUBLE AS last_seen, count(*) AS events FROM s GROUP BY 1, 2""")
def _(spark, sf):
    return ga.sessions(table(spark, sf, "events"), ["user_id"], "ts", 3600)


@query("idle_users", "R12", """
WITH l AS (SELECT user_id, max(epoch_us(ts) / 1000000.0) AS last_seen FROM events GROUP BY 1)
SELECT user_id, last_seen::DOUBLE AS last_seen, (ceil((last_seen + 3600) / 300.0) * 300)::BIGINT AS stopped_at FROM l
WHERE epoch(TIMESTAMP '2024-01-31') - last_seen >= 3600""")
def _(spark, sf):
    return ga.idle_users(table(spark, sf, "events"), ["user_id"], "ts", 1706659200.0)


# -- costs ------------------------------------------------------------------------

@query("scenario_costs", "A37", """
WITH c AS (SELECT event_type AS scenario, count(*) AS hours, round(avg(value), 2) AS rate FROM events GROUP BY 1),
m AS (SELECT *, hours * rate AS monthly_cost FROM c)
SELECT scenario, hours, rate, round(monthly_cost, 2) AS monthly_cost,
  round((b.base - monthly_cost) * 100 / b.base, 4) AS savings_percent
FROM m, (SELECT monthly_cost AS base FROM m WHERE scenario = 'signup') b""")
def _(spark, sf):
    sheet = table(spark, sf, "events").groupBy(F.col("event_type").alias("scenario")).agg(
        F.count("*").alias("hours"), F.round(F.avg("value"), 2).alias("rate"))
    out = me.scenario_costs(sheet, "scenario", "hours", "rate", "signup")
    return rounded(rounded(out, "savings_percent"), "monthly_cost", places=2)


@query("cost_lines", "S19", """
SELECT event_id, event_type AS namespace, CASE WHEN event_type = 'view' THEN 0 ELSE value END AS cost FROM events WHERE event_type <> 'error'""")
def _(spark, sf):
    kind = F.col("event_type")
    cost = F.when(kind == "view", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    line = F.when(kind == "error", F.lit("no cost here")).otherwise(
        F.concat(F.lit("ns info namespace="), kind, F.lit(" cost="), cost))
    return me.parse_cost_lines(table(spark, sf, "events").select("event_id", line.alias("value")))


@query("cost_by_namespace", "A38", """
SELECT event_type AS namespace, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, round(sum(value), 4) AS cost FROM events GROUP BY 1, 2""")
def _(spark, sf):
    line = F.concat(F.lit("namespace="), F.col("event_type"), F.lit(" cost="), F.col("value").cast("string"))
    rows = me.parse_cost_lines(table(spark, sf, "events").select("ts", line.alias("value")))
    out = me.cost_by_namespace(rows, "ts")
    return rounded(out.select("namespace", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "cost"))


# -- window features: batch form of the streaming builders ---------------------------

@query("window_features", "A41 R4 R7 X2 X5", """
WITH w AS (SELECT event_type AS sensor_id, time_bucket(INTERVAL 1 DAY, ts) AS w, value FROM events),
s AS (SELECT sensor_id, w, avg(value) AS a, stddev_pop(value) AS s FROM w GROUP BY 1, 2)
SELECT sensor_id, epoch_ms(w)::BIGINT AS window_start, epoch_ms(w + INTERVAL 1 DAY)::BIGINT AS window_end,
  strftime(w + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS event_time, round(any_value(a)::DECIMAL(30, 9), 2)::DOUBLE AS avg_value, round(min(value), 2) AS min_value,
  round(max(value), 2) AS max_value, round(any_value(s)::DECIMAL(30, 9), 2)::DOUBLE AS std_dev, count(*) AS count,
  count(*) FILTER (abs(value - a) > 2.5 * s) AS anomaly_count,
  round((count(*) FILTER (abs(value - a) > 2.5 * s) / count(*))::DECIMAL(30, 9), 3)::DOUBLE AS anomaly_rate
FROM w JOIN s USING (sensor_id, w) GROUP BY sensor_id, w""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("sensor_id"), F.col("ts").cast("timestamp").alias("event_time"), "value")
    return se.window_features(e, width="1 day")


@query("window_means", "A40 R4 X3", """
SELECT event_type AS sensor_id, round(avg(value), 4) AS avg_value, epoch_ms(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR)::BIGINT AS ts
FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts)""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("sensor_id"), F.col("ts").cast("timestamp").alias("event_time"), "value")
    out = se.window_means(e, width="1 hour")
    return rounded(out.withColumn("ts", F.unix_millis("ts")))


@query("window_feature_messages", "X1 S9 P3", """
WITH w AS (SELECT user_id::VARCHAR AS sensor_id, time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01') AS w, value FROM events)
SELECT sensor_id, epoch_ms(w)::BIGINT AS window_start, count(*) AS n FROM w GROUP BY 1, 2""")
def _(spark, sf):
    from opspark.sources.schemas import WINDOW_FEATURES
    from opspark.sources.sinks import to_messages

    e = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("sensor_id"), F.col("ts").cast("timestamp").alias("event_time"), "value")
    sent = to_messages(se.nested(se.window_features(e, width="5 days")))
    back = sent.select(F.from_json("value", WINDOW_FEATURES).alias("m"))
    return back.select("m.sensor_id", "m.window_start", F.col("m.features.count").alias("n"))


@query("parsed_readings", "P6 X1 X2 Y1 R1", """
SELECT event_type AS sensor_id, (epoch_us(ts) // 1000)::BIGINT AS timestamp, value FROM events WHERE event_type NOT IN ('error', 'signup')""")
def _(spark, sf):
    from opspark.sources.readers import accepted, parse_readings

    return accepted(parse_readings(_messages(spark, sf)))


@query("rejected_readings", "P6 R1", "SELECT event_type AS kind, count(*) AS rejected FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1")
def _(spark, sf):
    from opspark.sources.readers import parse_readings, rejected

    out = rejected(parse_readings(_messages(spark, sf)))
    kind = F.when(F.col("message").startswith("{"), "signup").otherwise("error")
    return out.groupBy(kind.alias("kind")).agg(F.count("*").alias("rejected"))


def _messages(spark, sf):
    e = table(spark, sf, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    whole = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), F.col("ms").alias("timestamp"), "value"))
    lacking = F.to_json(F.struct(F.col("event_type").alias("sensor_id"), "value"))
    kind = F.col("event_type")
    return e.select(F.when(kind == "error", F.lit("not json")).when(kind == "signup", lacking).otherwise(whole).alias("value"))


@query("json_properties", "X1 P6", """
SELECT json_extract(props, '$.k')::BIGINT % 10 AS k, count(*) AS rows, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.from_json("props", "k BIGINT")["k"])
    return rounded(e.groupBy((F.col("k") % 10).alias("k")).agg(F.count("*").alias("rows"), F.sum("value").alias("total")))


@query("path_and_version_stamps", "X4 S14", """
SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey || '.json' AS path,
  'v_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS version FROM orders""")
def _(spark, sf):
    from opspark.sources.sinks import evidence_path, version_stamp

    o = table(spark, sf, "orders")
    return o.select("o_orderkey", evidence_path(F.col("o_orderdate"), F.col("o_orderkey")).alias("path"),
                    version_stamp(F.col("o_orderdate")).alias("version"))
