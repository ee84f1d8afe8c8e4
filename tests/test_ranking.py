"""Order statistics and running totals against numpy, with the large-data paths forced."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.operators.quantiles import exact_quantiles, grouped_quantiles
from opspark.operators.ranking import hash_rank, rank_cutoffs, running_totals


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("limit", [3, 100_000])
@pytest.mark.parametrize("kind", ["distinct", "hot", "two_hot", "constant", "gaps", "far", "close"])
def test_exact_quantiles_match_numpy(spark, kind, limit):
    rng = np.random.default_rng(1)
    x = {
        "distinct": rng.normal(size=3000),
        "hot": np.concatenate([np.full(1000, 0.25), rng.normal(size=2000)]),
        "two_hot": np.concatenate([np.full(1500, 1.0), np.full(1499, 2.0), [1.5]]),
        "constant": np.full(500, 7.0),
        "gaps": rng.integers(0, 5, 3000) * 10.0,
        "far": rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000),
        "close": 1e15 + rng.integers(0, 900, 2000) * 0.125,
    }[kind]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = column(spark, list(x) + [None])
    got = exact_quantiles(df, {"x": F.col("x")}, probs, limit=limit)["x"]
    want = np.quantile(x, probs)
    if kind in ("hot", "far"):  # and as of groups, by tables alone
        again = {r.prob: r.value for r in grouped_quantiles(df, [], {"x": F.col("x")}, probs, limit=limit).collect()}
        assert [again[p] for p in probs] == got
    assert np.all(np.abs(np.array(got) - want) <= 1e-12 * np.abs(want))


def test_quantiles_of_nothing(spark):
    df = column(spark, [None, None])
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5])["x"] == [None]


def test_quantiles_of_many_columns_share_scans(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"))
    got = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, [0.5], limit=10)
    assert got == {"a": [499.5], "b": [999.0]}


def test_scans_do_not_grow_with_columns_or_groups(spark, folder, monkeypatch):
    """200 columns, and 5 000 groups, are read as often as one: scans are counted as files opened for the source."""
    from opspark.operators import quantiles as qu

    path = f"{folder}/wide"
    spark.range(400).select(*[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 7.0).alias(f"c{c}") for c in range(200)]).coalesce(1).write.parquet(path)
    reads = []
    before = qu._tall
    monkeypatch.setattr(qu, "_tall", lambda *a: reads.append(1) or before(*a))
    within = qu._within
    monkeypatch.setattr(qu, "_within", lambda *a: reads.append(1) or within(*a))
    df = spark.read.parquet(path)
    wide = exact_quantiles(df, {f"c{c}": F.col(f"c{c}") for c in range(200)}, [0.25, 0.5, 0.75], limit=50)
    of_200 = len(reads)
    reads.clear()
    one = exact_quantiles(df, {"c3": F.col("c3")}, [0.25, 0.5, 0.75], limit=50)
    assert wide["c3"] == one["c3"] and of_200 <= max(3, len(reads))
    x = np.array([[r[c] for c in range(200)] for r in df.collect()])
    assert np.allclose([wide[f"c{c}"] for c in range(200)], np.quantile(x, [0.25, 0.5, 0.75], axis=0).T, rtol=1e-12)
    reads.clear()
    many = spark.range(40_000).select((F.col("id") % 5000).alias("service"), (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / 3.0).alias("v"))
    got = {(r.service, r.prob): r.value for r in grouped_quantiles(many, ["service"], {"v": F.col("v")}, [0.5, 0.99]).collect()}
    assert len(reads) == 2 and len(got) == 10_000
    v = many.where("service = 77").toPandas().v
    assert got[(77, 0.5)] == pytest.approx(np.quantile(v, 0.5), rel=1e-12) and got[(77, 0.99)] == pytest.approx(np.quantile(v, 0.99), rel=1e-12)


def test_quantiles_of_a_hot_group_null_keys_and_odd_numbers(spark):
    rows = [("hot", float(i % 997)) for i in range(5000)] + [(None, 1.0), (None, 2.0), ("one", -0.0), ("none", None)]
    rows += [("odd", x) for x in (float("-inf"), -5e-324, 0.0, 5e-324, float("inf"), float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.prob): r.value for r in grouped_quantiles(df, ["k"], {"v": F.col("v")}, [0.0, 0.5, 1.0], limit=4).collect()}
    assert got[("hot", 0.5)] == np.quantile([i % 997 for i in range(5000)], 0.5) and got[(None, 0.5)] == 1.5 and got[("one", 1.0)] == 0.0
    assert ("none", 0.5) not in got and got[("odd", 0.0)] == float("-inf") and got[("odd", 1.0)] == float("inf")


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_by_key(spark, descending):
    rng = np.random.default_rng(2)
    rows = [(k, float(v), int(w)) for k in "ab" for v, w in zip(rng.permutation(500), rng.integers(0, 9, 500))]
    df = spark.createDataFrame(rows, "k string, v double, w bigint")
    got = {(r.k, r.v): (r.cum_w, r.total_w) for r in running_totals(df, ["k"], "v", ["w"], descending=descending).collect()}
    for k in "ab":
        mine = sorted([(v, w) for kk, v, w in rows if kk == k], reverse=descending)
        cum = 0
        for v, w in mine:
            cum += w
            assert got[(k, v)] == (cum, sum(w for _, w in mine))


def test_running_totals_of_texts(spark):
    words = sorted({f"{i * 7919 % 5000:05d}" for i in range(3000)})
    df = spark.createDataFrame([(w, 1) for w in words], "w string, one int")
    got = {r.w: r.cum_one for r in running_totals(df, [], "w", ["one"]).collect()}
    assert got == {w: i + 1 for i, w in enumerate(words)}


def test_running_totals_with_a_hot_key_use_many_tasks(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(1).alias("one"))
    out = running_totals(df, ["k"], "t", ["one"], bucket=F.floor(F.col("t") / 100))
    assert out.where("cum_one <> t + 1").count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "_bucket" in plan.split("Window")[1]


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("g"))
    got = hash_rank(df, ["g"], "id", 42)
    for r in got.groupBy("g").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.count_distinct("rank").alias("n"),
                                  F.max("rank_total").alias("t")).collect():
        assert r.a == 1 and r.b == r.n == r.t


def test_cutoffs_agree_with_ranks(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    ranked = {(r.g, r.rank): r.id for r in hash_rank(df, ["g"], "id", 42).collect()}
    cuts = rank_cutoffs(df, "g", "id", 42, {"0": [1, 100], "1": [50, 660], "2": [0, 3]})
    assert cuts[("0", 0)][1] == ranked[("0", 1)] and cuts[("0", 1)][1] == ranked[("0", 100)]
    assert cuts[("1", 1)][1] == ranked[("1", 660)] and ("2", 0) not in cuts


def test_many_cuts_are_found_in_two_levels(spark):
    from opspark.operators import ranking as rk

    edges = spark.createDataFrame([([float(i) for i in range(500)],)], "e array<double>")
    values = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.5, 63, 64, 64.5, 200.2, 499, 600)] + [(None,)], "v double")
    marked = values.withColumn("_edges", rk._two_levels(edges).scalar())
    got = {r.v: r._bucket for r in rk._by_edges(marked, F.col("v"), ["v"]).collect()}
    assert got == {None: 0} | {v: sum(e < v for e in range(500)) for v in (-1.0, 0.0, 0.5, 63.0, 64.0, 64.5, 200.2, 499.0, 600.0)}
