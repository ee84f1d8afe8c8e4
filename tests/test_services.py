import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.operators import evidence as evd, gates as ga, lineage as ln, metrics as me, policy as po, store as st
from opspark.sources.schemas import RESOURCE


def at(s):
    return datetime(2024, 1, 1) + timedelta(seconds=s)


# -- feature tables ----------------------------------------------------------

def brute_as_of(spine, history, ttl):
    out = {}
    for i, k, t in spine:
        best = max(((ht, v) for hk, ht, v in history if hk == k and ht <= t and t - ht <= ttl), default=None)
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("slices", [1, 4, 13])
def test_point_in_time_matches_full_search(spark, slices):
    rng = np.random.default_rng(6)
    spine = [(i, "hot" if i % 3 else f"k{i % 5}", int(t)) for i, t in enumerate(rng.integers(0, 5000, 300))]
    # one reading per key and second, so the newest one is unique
    seen = {("hot" if i % 3 else f"k{i % 6}", int(t)): float(i) for i, t in enumerate(rng.integers(0, 5000, 200))}
    history = [(k, t, v) for (k, t), v in seen.items()]
    a = spark.createDataFrame([(i, k, at(t)) for i, k, t in spine], "i int, k string, ts timestamp")
    b = spark.createDataFrame([(k, at(t), v) for k, t, v in history], "k string, ts timestamp, v double")
    got = {r.i: r.v for r in st.point_in_time(a, b, ["k"], "ts", "ts", ["v"], timedelta(seconds=300), slices=slices).collect()}
    assert got == brute_as_of(spine, history, 300)


def test_point_in_time_edges(spark):
    a = spark.createDataFrame([(1, "x", at(100)), (2, "x", at(160)), (3, "x", at(161)), (4, "y", at(100))], "i int, k string, ts timestamp")
    b = spark.createDataFrame([("x", at(100), 5.0), ("x", at(101), None)], "k string, ts timestamp, v double")
    got = {r.i: r.v for r in st.point_in_time(a, b.where("v is not null"), ["k"], "ts", "ts", ["v"], timedelta(seconds=60)).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: None, 4: None}


def test_point_in_time_has_no_range_join(spark):
    a = spark.createDataFrame([(1, "x", at(1))], "i int, k string, ts timestamp")
    b = spark.createDataFrame([("x", at(1), 5.0)], "k string, ts timestamp, v double")
    plan = st.point_in_time(a, b, ["k"], "ts", "ts", ["v"], timedelta(days=1))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_lookup_of_unknown_and_stale(spark):
    table = spark.createDataFrame([(1001, at(0), 0.5), (1002, at(90000), 0.7)], "driver_id int, ts timestamp, conv double")
    asked = spark.createDataFrame([(1001,), (1002,), (9,)], "driver_id int")
    plain = {r.driver_id: r.conv for r in st.online_lookup(asked, table, ["driver_id"], ["conv"]).collect()}
    assert plain == {1001: 0.5, 1002: 0.7, 9: None}
    fresh = st.online_lookup(asked, table, ["driver_id"], ["conv"], "ts", at(90001), timedelta(days=1))
    assert {r.driver_id: r.conv for r in fresh.collect()} == {1001: None, 1002: 0.7, 9: None}


def test_merge_prefers_newer_then_the_new_side(spark):
    old = spark.createDataFrame([("a", at(5), 1), ("b", at(5), 2)], "k string, ts timestamp, v int")
    new = spark.createDataFrame([("a", at(5), 10), ("b", at(4), 20), ("c", at(1), 30)], "k string, ts timestamp, v int")
    assert {r.k: r.v for r in st.merge_latest(old, new, ["k"], "ts").collect()} == {"a": 10, "b": 2, "c": 30}


# -- metrics -----------------------------------------------------------------

def test_rate_with_reset_and_single_sample(spark):
    rows = [("a", 0, 10.0), ("a", 60, 16.0), ("a", 120, 4.0), ("b", 30, 7.0)]
    df = spark.createDataFrame([(s, at(t), v) for s, t, v in rows], "s string, ts timestamp, v double")
    got = {r.s: r for r in me.counter_rate(df, ["s"], "ts", "v", 300).collect()}
    assert got["a"].increase == 10.0 and math.isclose(got["a"].rate, 10 / 120)
    assert got["b"].rate is None and got["b"].samples == 1


@pytest.mark.parametrize("step", [30, 60, 300])
def test_sliding_rates_match_row_windows(spark, step):
    rng = np.random.default_rng(7)
    times = np.sort(rng.choice(4000, 300, replace=False))
    values = np.cumsum(rng.integers(0, 5, 300)) % 50
    df = spark.createDataFrame([("s", at(int(t)), float(v)) for t, v in zip(times, values)], "s string, ts timestamp, v double")
    base = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds())
    got = {r.eval_at - base: r for r in me.counter_rate(df, ["s"], "ts", "v", 300, step).collect()}
    for end, r in got.items():
        inside = [(t, v) for t, v in zip(times, values) if end - 300 <= t < end]
        grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
        assert r.samples == len(inside) and r.increase == grown
        if len(inside) > 1:
            assert math.isclose(r.rate, grown / (inside[-1][0] - inside[0][0]), abs_tol=1e-12)
    with pytest.raises(ValueError):
        me.counter_rate(df, ["s"], "ts", "v", 300, 77)


def test_a_hot_series_is_scanned_in_many_cells(spark):
    """One series with all its samples in one hour, some at one instant: many tasks, the result of one scan."""
    from pyspark.sql import Window as W

    base = spark.range(20_000).select(
        F.lit(None).cast("string").alias("s"), F.timestamp_seconds(F.lit(1_704_067_200) + F.when(F.col("id") < 9000, 7).otherwise(F.col("id") % 3000)).alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(50))).cast("double").alias("v"), F.col("id").alias("n"))
    hot = me.counter_panes(base, ["s"], "ts", "v", 600, ["n"], cell_rows=100)
    plain = me.counter_panes(base, ["s"], "ts", "v", 600, ["n"])
    assert plain.exceptAll(hot.select(*plain.columns)).isEmpty() and hot.select(*plain.columns).exceptAll(plain).isEmpty()
    from opspark.operators.scans import with_heads

    base = base.withColumn("w", F.col("v") * 2).withColumn("x", F.when(F.col("n") % 5000 == 1, F.col("v")))
    rows, series = with_heads(base, ["s"], ["ts", "n"], last=["v"], latest=["x"], totals=["w"], cells=16)
    sizes = [r["count"] for r in rows.where("_head = 1").groupBy("_cell").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 4000
    whole = W.partitionBy("s").orderBy("ts", "n")
    upto = (series.rowsBetween(W.unboundedPreceding, W.currentRow), whole.rowsBetween(W.unboundedPreceding, W.currentRow))
    def scan(df, window, sofar, *more):
        return df.select(*more, "n", F.lag("v").over(window).alias("a"), F.sum("w").over(sofar).alias("b"), F.last("x", True).over(sofar).alias("c"))

    got = scan(rows, series, upto[0], "_head").where("_head = 1").drop("_head")
    want = scan(base, whole, upto[1])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_keys_of_a_point_in_time_join(spark):
    rng = np.random.default_rng(5)
    hist = [("hot", at(int(t)), int(t), i) for i, t in enumerate(rng.integers(0, 90_000, 2000))] + [(None, at(5), 1, 9)]
    spine = [("hot", at(int(t)), i) for i, t in enumerate(rng.integers(0, 100_000, 1000))] + [("cold", at(3), -1)]
    spine += [("hot", at(500), 5000 + i) for i in range(500)]
    h = spark.createDataFrame(hist, "k string, ts timestamp, v long, t long")
    s = spark.createDataFrame(spine, "k string, ts timestamp, id long")
    args = (s, h, ["k"], "ts", "ts", ["v"], timedelta(hours=6), "t")
    hot, plain = st.point_in_time(*args, cell_rows=50), st.point_in_time(*args)
    assert hot.exceptAll(plain).isEmpty() and plain.exceptAll(hot).isEmpty() and hot.where("v is null").count() < hot.count()


def test_missing_numerator_gives_no_row(spark):
    df = spark.createDataFrame([("v1", "200", 3.0), ("v1", "503", 1.0), ("v2", "503", 1.0), ("v3", "200", 0.0)], "v string, c string, r double")
    got = {r.v: r.ratio for r in me.vector_ratio(df, ["v"], me.matches(F.col("c"), "=~", "2.."), F.col("r")).collect()}
    assert got == {"v1": 0.75, "v3": None}


def test_matchers_are_anchored(spark):
    df = spark.createDataFrame([("200",), ("1200",), (None,)], "c string")
    assert df.where(me.matches(F.col("c"), "=~", "2..")).count() == 1
    assert df.where(me.matches(F.col("c"), "!=", "200")).count() == 2
    with pytest.raises(ValueError):
        me.matches(F.col("c"), "~", "x")


def test_bucket_quantile_cases(spark):
    inf = float("inf")
    rows = [("a", 1.0, 0), ("a", 2.0, 10), ("a", inf, 10), ("b", 1.0, 1), ("b", inf, 100), ("c", 1.0, 0), ("c", inf, 0), ("d", 4.0, 8), ("d", inf, 8)]
    df = spark.createDataFrame(rows, "g string, le double, count int")
    got = {r.g: r.quantile for r in me.bucket_quantile(df, ["g"], 0.5).collect()}
    assert got == {"a": 1.5, "b": 1.0, "d": 2.0}


def test_scenario_costs(spark):
    df = spark.createDataFrame([("AlwaysOn", 720, 0.752), ("AutoScaled", 80, 0.752)], "s string, h int, r double")
    got = {r.s: r for r in me.scenario_costs(df, "s", "h", "r", "AlwaysOn").collect()}
    assert math.isclose(got["AlwaysOn"].monthly_cost, 541.44) and math.isclose(got["AutoScaled"].monthly_cost, 60.16)
    assert round(got["AutoScaled"].savings_percent, 2) == 88.89


def test_cost_lines(spark):
    df = spark.createDataFrame([("namespace=a cost=1.5",), ("x namespace=b   cost=oops",), ("nothing",)], "value string")
    assert sorted((r.namespace, r.cost) for r in me.parse_cost_lines(df).collect()) == [("a", 1.5), ("b", 0.0)]


# -- gates -------------------------------------------------------------------

def test_alert_hold(spark):
    rows = [("s", t, v) for t, v in [(0, 2.0), (30, 2.0), (60, 2.0), (90, 0.5), (120, None), (150, 2.0), (210, 2.0)]]
    df = spark.createDataFrame(rows, "s string, at int, v double")
    got = [r.state for r in ga.alert_states(df, ["s"], "at", F.col("v") > 1, 60).orderBy("at").collect()]
    assert got == ["pending", "pending", "firing", "inactive", "inactive", "pending", "firing"]


def test_canary_gate(spark):
    rows = [("s", 0, 0.99), ("s", 1, 0.95), ("s", 2, 0.97), ("s", 3, 0.94), ("s", 4, None), ("s", 5, 0.99), ("s", 6, 0.99)]
    got = [r.verdict for r in ga.canary_gate(spark.createDataFrame(rows, "s string, at int, v double"), ["s"], "at", "v").orderBy("at").collect()]
    assert got == ["inconclusive", "inconclusive", "successful", "failed", "failed", "failed", "inconclusive"]


def test_staged_rollout_stops_at_the_first_failure(spark):
    df = spark.createDataFrame([("a", 10, True), ("a", 50, False), ("a", 100, True), ("b", 10, None)], "s string, w int, ok boolean")
    got = {(r.s, r.w): r.action for r in ga.staged_rollout(df, ["s"], "w", "ok").collect()}
    assert got == {("a", 10): "promote", ("a", 50): "abort", ("a", 100): "skipped", ("b", 10): "abort"}


def test_analysis_gate_failure_limit(spark):
    rows = [("a", 0.99, 100.0)] * 5 + [("a", 0.5, 100.0)] * 3 + [("b", 0.99, 2000.0)] * 4
    got = {r.s: (r.failures, r.decision) for r in ga.analysis_gate(spark.createDataFrame(rows, "s string, ok double, p double"), ["s"], "ok", "p").collect()}
    assert got == {"a": (3, "promote"), "b": (4, "rollback")}


@pytest.mark.parametrize("cells", [{}, {"cell_rows": 5}])
@pytest.mark.parametrize("bucket", [7, 86400])
def test_error_runs_across_buckets(spark, bucket, cells):
    pattern = "EEEEE.EEEE.EEEEEEEEEEEE..E"
    rows = [("i", at(3 * t), c == "E") for t, c in enumerate(pattern)] + [("j", at(t), True) for t in range(100)]
    df = spark.createDataFrame(rows, "i string, ts timestamp, bad boolean")
    got = sorted((r.i, r.run_length) for r in ga.error_runs(df, ["i"], "ts", F.col("bad"), bucket_seconds=bucket, **cells).collect())
    assert got == [("i", 5), ("i", 12), ("j", 100)]


def test_sessions_split_at_the_exact_gap(spark):
    rows = [("u", at(t)) for t in (0, 3599, 7199, 7200 + 3599, 20000)]
    df = spark.createDataFrame(rows, "u string, ts timestamp")
    got = [(r.events) for r in ga.sessions(df, ["u"], "ts", 3600).orderBy("session").collect()]
    assert got == [2, 1, 1, 1]
    idle = ga.idle_users(df, ["u"], "ts", (at(20000) - datetime(1970, 1, 1)).total_seconds() + 3600).collect()
    assert len(idle) == 1 and idle[0].stopped_at % 300 == 0


def test_traffic_split_share_and_header(spark):
    df = spark.range(20000).select("id", ga.traffic_split(F.col("id"), 10).alias("v"))
    assert 0.08 < df.where("v = 'v2'").count() / 20000 < 0.12
    forced = spark.range(10).select(ga.traffic_split(F.col("id"), 0, F.lit("v2")).alias("v"))
    assert forced.where("v = 'v2'").count() == 10


# -- audit -------------------------------------------------------------------

def resource(spark, doc):
    import json

    return spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.from_json("j", RESOURCE).alias("r")).select("r.*")


def pod(**spec):
    return {"kind": "Pod", "metadata": {"name": "p", "namespace": "n"}, "spec": spec}


def messages(df):
    return sorted(r.msg for r in df.collect())


def test_latest_only_where_not_exempt(spark):
    doc = pod(containers=[{"name": "a", "image": "x:latest"}, {"name": "b", "image": "k8s.gcr.io/y:latest"}, {"name": "c", "image": "z:1"}],
              initContainers=[{"name": "i", "image": "w:latest"}])
    got = messages(po.deny_latest(resource(spark, doc)))
    assert [m.split(" image")[0] for m in got] == ["Pod container", "Pod init container"]
    assert messages(po.deny_latest(resource(spark, {**doc, "metadata": {"name": "p", "namespace": "kube-system"}}))) == []


def test_job_images_are_reported_by_both_heads(spark):
    doc = {"kind": "Job", "metadata": {"name": "j", "namespace": "n"}, "spec": {"template": {"spec": {"containers": [{"name": "a", "image": "x:latest"}]}}}}
    assert [m.split(" image")[0] for m in messages(po.deny_latest(resource(spark, doc)))] == ["Container", "Job container"]


def test_limits_with_missing_parts(spark):
    doc = {"kind": "CronJob", "metadata": {"name": "c", "namespace": "n"}, "spec": {"jobTemplate": {"spec": {"template": {"spec": {
        "containers": [{"name": "a", "resources": {"limits": {"cpu": "1"}}}, {"name": "istio-proxy"}]}}}}}}
    assert len(messages(po.require_limits(resource(spark, doc)))) == 3
    assert len(messages(po.require_limits(resource(spark, doc), requests=False, ephemeral=True))) == 2


def test_public_balancer(spark):
    def service(ns, **notes):
        return resource(spark, {"kind": "Service", "metadata": {"name": "s", "namespace": ns, "annotations": notes}, "spec": {"type": "LoadBalancer"}})
    assert len(messages(po.block_public_balancer(service("n")))) == 1
    assert messages(po.block_public_balancer(service("n", **{po.GCP_INTERNAL: "Internal"}))) == []
    assert messages(po.block_public_balancer(service("production-public"))) == []
    assert len(messages(po.block_public_balancer(service("n", **{po.AWS_INTERNAL: "false"})))) == 1


def test_security_levels(spark):
    doc = resource(spark, pod(hostPID=True, volumes=[{"name": "v", "hostPath": "/x"}], containers=[
        {"name": "a", "securityContext": {"privileged": True, "capabilities": {"add": ["CAP_SYS_ADMIN", "CAP_CHOWN"]}}},
        {"name": "vault-agent", "securityContext": {"privileged": True}}]))
    assert messages(po.pod_security(doc, "privileged")) == []
    assert len(messages(po.pod_security(doc, "baseline"))) == 3
    assert len(messages(po.pod_security(doc, "restricted"))) == 3 + 4 + 1
    with pytest.raises(ValueError):
        po.pod_security(doc, "strict")


def test_audits_do_not_shuffle(spark):
    plan = po.require_limits(resource(spark, pod()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_compliance_of_nothing(spark):
    row = po.compliance_score(spark.createDataFrame([(None, None, None, None)], "total_pass long, total_fail long, total_warn long, total_info long")).first()
    assert (row.total_checks, row.compliance_score, row.status) == (0, 0.0, "NON-COMPLIANT")


def test_canonical_json_is_sorted_and_spaced(spark):
    import json

    df = spark.createDataFrame([('q"uote', "b\\s")], "b string, a string")
    assert df.select(evd.canonical_json(["b", "a"])).first()[0] == json.dumps({"b": 'q"uote', "a": "b\\s"}, sort_keys=True)


def test_closure_survives_cycles_and_deep_graphs(spark):
    cyc = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", None)], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "root string")
    assert {(r.node, r.depth) for r in ln.closure(cyc, roots).collect()} == {("b", 1), ("c", 2), ("d", 3)}
    assert {r.node for r in ln.closure(cyc, spark.createDataFrame([("d",)], "root string"), upstream=True).collect()} == {"a", "b", "c"}
    deep = spark.createDataFrame([(str(i), str(i + 1)) for i in range(12)], "src string, dst string")
    assert ln.closure(deep, spark.createDataFrame([("0",)], "root string")).agg({"depth": "max"}).first()[0] == 12


def test_closure_of_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 10 000 with branches, a ring that is joined and one that is not; depths equal those of a plain search."""
    links = [(f"n{i}", f"n{i + 1}") for i in range(10_000)] + [("n3", "side"), ("side", "n9"), ("n9000", "loop"), ("loop", "loop2"), ("loop2", "n9000")]
    links += [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("n10000", "own"), ("own", "own")]
    rounds = []
    cut = ln.cut_lineage
    monkeypatch.setattr(ln, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    got = {r.node: r.depth for r in ln.closure(spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame([("n0",), ("gone",)], "root string")).collect()}
    assert len(rounds) < 30
    from collections import defaultdict, deque

    ahead = defaultdict(list)
    for a, b in links:
        ahead[a].append(b)
    want, queue = {}, deque([("n0", 0)])
    while queue:
        node, depth = queue.popleft()
        for b in ahead[node]:
            if b not in want and b != "n0":
                want[b] = depth + 1
                queue.append((b, depth + 1))
    assert got == want


def test_closure_of_random_graphs(spark):
    draw = np.random.default_rng(8)
    for size in (30, 200):
        links = {(int(a), int(b)) for a, b in zip(draw.integers(0, size, size + 20), draw.integers(0, size, size + 20))}
        roots = [0, 1, 2, 3]
        want = set()
        for root in roots:
            seen, front, depth = {root}, {root}, 0
            while front:
                depth += 1
                front = {b for a, b in links if a in front} - seen
                seen |= front
                want |= {(root, b, depth) for b in front}
        df = spark.createDataFrame(list(links), "src long, dst long")
        assert {tuple(r) for r in ln.closure(df, spark.createDataFrame([(r,) for r in roots], "root long")).collect()} == want


def test_span_self_time(spark):
    rows = [("t", "1", None, "http", at(0), at(10)), ("t", "2", "1", "db", at(1), at(4)), ("t", "3", "1", "model", at(4), at(9))]
    got = {r.name: r for r in ln.span_breakdown(spark.createDataFrame(
        rows, "trace_id string, span_id string, parent_id string, name string, start timestamp, end timestamp")).collect()}
    assert (got["http"].self_time, got["db"].self_time, got["model"].self_time) == (2.0, 3.0, 5.0)
    assert math.isclose(got["model"].share, 0.5)


def test_closure_of_a_flat_graph_contracts_nothing(spark, monkeypatch):
    """A graph of few levels pays for no chains; branches that meet again and rings end."""
    monkeypatch.setattr(ln, "chains", None)
    links = [("r", f"a{i}") for i in range(5)] + [(f"a{i}", f"b{i % 2}") for i in range(5)] + [("b0", "c"), ("b1", "c"), ("c", "b0"), ("r", "c")]
    got = ln.closure(spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame([("r",), ("b1",)], "root string"))
    assert sorted(map(tuple, got.collect())) == sorted(
        [("r", f"a{i}", 1) for i in range(5)] + [("r", "c", 1), ("r", "b0", 2), ("r", "b1", 2), ("b1", "c", 1), ("b1", "b0", 2)])


@pytest.mark.parametrize("plain, rows", [(0, 500_000), (2, 500_000), (6, 60)])
def test_closure_is_the_same_however_it_goes_on(spark, monkeypatch, plain, rows):
    """Chains contracted at once or amid the search, and rounds that look ahead from few nodes."""
    monkeypatch.setattr(ln, "PLAIN", plain)
    monkeypatch.setattr(ln, "BROADCAST_ROWS", rows)
    draw = np.random.default_rng(3)
    links = {(int(a), int(b)) for a, b in zip(draw.integers(0, 40, 55), draw.integers(0, 40, 55))} | {(i, i + 1) for i in range(40, 52)} | {(5, 40), (46, 7)}
    want = set()
    for root in range(0, 40, 4):
        depth, front = {}, {root}
        for d in range(1, 60):
            front = {b for a, b in links if a in front} - depth.keys() - {root}
            depth |= {b: d for b in front}
        want |= {(root, b, d) for b, d in depth.items()}
    roots = spark.createDataFrame([(r,) for r in range(0, 40, 4)], "root long")
    got = [tuple(r) for r in ln.closure(spark.createDataFrame(sorted(links), "src long, dst long"), roots).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_audit_shuffles_only_messages_of_resources_that_come_twice(spark):
    """Resources that stand alone give their messages without a distinct; of those that come twice equal messages stay once."""

    def balancer(name, space="team-a"):
        return {"kind": "Service", "metadata": {"name": name, "namespace": space}, "spec": {"type": "LoadBalancer"}}

    def of_images(name, *images):
        return {"kind": "Pod", "metadata": {"name": name}, "spec": {"containers": [{"name": i, "image": i + ":latest"} for i in images]}}

    alone = spark.createDataFrame([balancer("a"), balancer("b"), of_images("c", "x", "x", "y"), of_images(None, "z")], RESOURCE)
    rows = [tuple(r) for r in po.audit(alone).collect()]
    assert len(rows) == len(set(rows)) == 2 + 2 + 1 + 4 * 3
    assert "keys=[kind" not in po.audit(alone)._jdf.queryExecution().executedPlan().toString()
    twice = alone.unionAll(alone).unionAll(spark.createDataFrame([balancer("a", "team-b"), of_images("c", "y", "w")], RESOURCE))
    again = [tuple(r) for r in po.audit(twice).collect()]
    assert len(again) == len(set(again)) and set(again) > set(rows) and len(again) == len(rows) + 1 + 1 + 4
