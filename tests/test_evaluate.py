import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.operators import drift as dr, evaluate as ev


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(y * 0.3 + rng.uniform(size=400), 2)
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id int, y int, s double")


def pairs_auc(rows):
    pos = [r.s for r in rows if r.y == 1]
    neg = [r.s for r in rows if r.y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_counts_ordered_pairs(scored):
    assert math.isclose(ev.roc_auc(scored, "y", "s").first()[0], pairs_auc(scored.collect()), rel_tol=1e-12)


def test_auc_of_the_reversed_score(scored):
    a = ev.roc_auc(scored, "y", "s").first()[0]
    b = ev.roc_auc(scored.withColumn("s", -F.col("s")), "y", "s").first()[0]
    assert math.isclose(a + b, 1.0)


def test_curve_ends(scored):
    last = ev.roc_curve(scored, "y", "s").orderBy("threshold").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)
    end = ev.pr_curve(scored, "y", "s").where("threshold is null").first()
    assert (end.precision, end.recall) == (1.0, 0.0)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    m = ev.classification_metrics(df, "y", "p").first()
    assert m.accuracy == 0.5 and math.isclose(m.precision, 0.5 * 1 + 0.25 / 3)
    assert math.isclose(m.recall, 0.5) and math.isclose(m.f1, 0.5 * 2 / 3 + 0.25 * 0.5)
    cells = {(r.y, r.p): r["rows"] for r in ev.confusion_matrix(df, "y", "p").collect()}
    assert cells[("c", "b")] == 1 and cells[("c", "c")] == 0 and len(cells) == 9


def test_regression_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 5.0)], "y double, p double")
    m = ev.regression_metrics(df, "y", "p").first()
    assert math.isclose(m.mse, 5 / 3) and math.isclose(m.mae, 1.0) and math.isclose(m.r2, 1 - (5 / 3) / (2 / 3))
    q = ev.error_percentiles(df, "y", "p").first()
    assert math.isclose(q[0], 1.0) and math.isclose(q[1], 1.8)


def test_constant_truth_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert ev.regression_metrics(df, "y", "p").first().r2 is None


def test_bootstrap_brackets_the_point_estimate(scored):
    df = scored.withColumn("p", (F.col("s") > 0.6).cast("int"))
    point = ev.classification_metrics(df, "y", "p").first()
    got = {r.metric: r for r in ev.bootstrap_classification(df, "y", "p", 300).collect()}
    for name in ("accuracy", "f1"):
        assert got[name].lower < point[name] < got[name].upper
        assert abs(got[name]["mean"] - point[name]) < 0.02
    want = math.sqrt(point.accuracy * (1 - point.accuracy) / 400)
    assert 0.5 * want < got["accuracy"]["std"] < 2 * want


@pytest.mark.parametrize("mean", [1, 30, 5000, 3_000_000])
def test_draws_of_a_cell_are_poisson(spark, mean):
    """Mean, variance and tail of 4 000 draws; a cell of one row has weights beyond 8."""
    draws = 4000 if mean > 1 else 400_000
    w = np.array([r.w for r in ev.poisson_draws(spark.createDataFrame([(None, mean)], "c string, n long"), ["c"], "n", draws, 7).collect()])
    assert len(w) == draws and abs(w.mean() - mean) < 5 * math.sqrt(mean / draws)
    assert abs(w.var() / mean - 1) < 0.15 and (mean > 1 or w.max() > 8)


def test_bootstrap_by_grid_agrees_with_resampled_rows(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(100, 20, 3000)
    p = y + rng.normal(0, 5, 3000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = {r.metric: r for r in ev.bootstrap_regression(df, "y", "p", 400, grid=64).collect()}
    draws = [rng.integers(0, 3000, 3000) for _ in range(400)]
    rmse = [math.sqrt(np.mean((y[d] - p[d]) ** 2)) for d in draws]
    assert got["rmse"].inside < 0.01 and abs(got["rmse"]["std"] / np.std(rmse) - 1) < 0.2 and abs(got["rmse"]["mean"] - np.mean(rmse)) < 0.02


def test_bootstrap_regression_leaves_no_row_out_of_the_draws(spark):
    """Each row has a weight of its own, by numpy's Poisson weights, so there is no share of the variance to report as missing."""
    y = [0.0, 1000.0] * 2 + [float(i % 50) for i in range(196)]
    p = [v + (300.0 if i < 2 else 1.0 + i % 7) for i, v in enumerate(y)]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    out = ev.bootstrap_regression(df, "y", "p", 3000)
    got = {r.metric: r for r in out.collect()}
    e2, c = (np.array(y) - np.array(p)) ** 2, np.array(y)
    w = np.random.default_rng(5).poisson(1, (3000, 200)).astype(float)
    n = w.sum(1)
    mse, mean = w @ e2 / n, w @ c / n
    want = {"rmse": np.sqrt(mse), "r2": 1 - mse / (w @ c**2 / n - mean**2)}
    assert out.columns == ["metric", "mean", "std", "lower", "upper"]
    for name, values in want.items():
        assert abs(got[name]["std"] / values.std() - 1) < 0.1, name
        for side, q in (("lower", 0.025), ("upper", 0.975)):
            assert abs(got[name][side] - np.quantile(values, q)) < 0.3 * values.std(), (name, side)


def test_draws_of_equal_counts_stand_alone(spark):
    """Cells of one count share a distribution, not their draws; each has every draw once."""
    cells = spark.createDataFrame([(i, n) for i in range(40) for n in (1, 3, 70)], "c int, n long").withColumn("k", F.concat_ws(":", "c", "n"))
    rows = ev.poisson_draws(cells, ["k"], "n", 500, 7).collect()
    assert len({(r.k, r.draw) for r in rows}) == len(rows) == 40 * 3 * 500
    for n in (1, 3, 70):
        w = np.zeros((40, 500))
        for r in rows:
            if r.n == n:
                w[r.c, r.draw - 1] = r.w
        assert abs(w.mean() / n - 1) < 0.05 and abs(w.sum(0).var() / (40 * n) - 1) < 0.3


def test_bootstrap_classification_weighs_every_row_of_every_draw(spark):
    """Weights by hashlib, a row at a time: rows of one truth and prediction are not drawn as one, and equal rows count apart."""
    rows = [(i // 2, i % 3 % 2, i % 5 % 2) for i in range(60)] + [(7, 1, 1)] * 3 + [(None, 1, 0)] * 2
    bounds, seen, names = [int(b, 16) for b in ev.weight_bounds()], {}, []
    for row in rows:
        seen[row] = seen.get(row, 0) + 1
        names.append("-".join("\\N" if v is None else str(v) for v in row) + f"-{seen[row]}")
    accuracy = []
    for draw in range(50):
        digests = [hashlib.sha256(f"{n}-{draw // 4}-42".encode()).hexdigest()[draw % 4 * 16:][:16] for n in names]
        w = np.array([sum(b <= int(d, 16) for b in bounds) for d in digests])
        accuracy.append(w[[y == p for _, y, p in rows]].sum() / w.sum())
    df = spark.createDataFrame(rows, "k int, y int, p int")
    for part in (df, df.repartition(5, "p")):
        got = {r.metric: r for r in ev.bootstrap_classification(part, "y", "p", 50, key=["k"]).collect()}["accuracy"]
        assert math.isclose(got["mean"], np.mean(accuracy)) and math.isclose(got["std"], np.std(accuracy))
        assert math.isclose(got.lower, np.quantile(accuracy, 0.025)) and math.isclose(got.upper, np.quantile(accuracy, 0.975))


def test_weights_of_rows_are_poisson_without_an_end(spark):
    w = ev.weighted_draws(spark.createDataFrame([("a", 2500), ("b", 1)], "k string, n long"), ["k"], 402, 3)
    got = w.groupBy("k").agg(F.count("*").alias("rows"), F.max("draw").alias("draws"), F.avg("w").alias("mean"), F.var_pop("w").alias("var"), F.max("w").alias("most")).collect()
    a, b = sorted(got)
    assert (a.rows, a.draws, b.rows, b.draws) == (2500 * 402, 402, 402, 402)
    assert abs(a["mean"] - 1) < 0.005 and abs(a["var"] - 1) < 0.01 and a["most"] > 7
    bounds = [int(x, 16) / 16**16 for x in ev.weight_bounds()]
    assert len(bounds) > 18 and np.allclose(bounds[:4], [math.exp(-1) * v for v in (1, 2, 2.5, 8 / 3)], rtol=1e-15)


def test_bootstrap_does_not_depend_on_partitioning(scored):
    a = ev.bootstrap_regression(scored, "y", "s", 50).orderBy("metric").collect()
    b = ev.bootstrap_regression(scored.repartition(3), "y", "s", 50).orderBy("metric").collect()
    for x, y in zip(a, b):
        assert math.isclose(x.lower, y.lower, rel_tol=1e-9) and math.isclose(x.upper, y.upper, rel_tol=1e-9)


def frame(spark, x, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in x], f"{name} double")


@pytest.mark.parametrize("method", ["ks", "chi2", "wasserstein", "psi"])
def test_no_drift_against_itself(spark, method):
    df = frame(spark, np.random.default_rng(1).normal(size=300))
    assert abs(dr.drift_scores(df, df, method=method).first().score) < 1e-9


def test_ks_and_wasserstein_match_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(size=400), 2), np.round(rng.normal(0.5, 2, size=250), 2)
    grid = np.sort(np.unique(np.concatenate([a, b])))
    fa, fb = np.searchsorted(np.sort(a), grid, "right") / 400, np.searchsorted(np.sort(b), grid, "right") / 250
    ra, rb = frame(spark, list(a) + [None]), frame(spark, list(b) + [float("nan")])
    assert math.isclose(dr.ks_scores(ra, rb, ["x"]).first().score, np.abs(fa - fb).max())
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid))
    assert math.isclose(dr.wasserstein_scores(ra, rb, ["x"]).first().score, w, rel_tol=1e-9)


def test_psi_and_chi_square_match_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=500), rng.normal(0.7, 1.5, size=300)
    ha, edges = np.histogram(a, bins=10)
    hb, _ = np.histogram(b, bins=edges)
    p, q = (ha + 1) / 510, (hb + 1) / 310
    assert math.isclose(dr.psi_scores(frame(spark, a), frame(spark, b), ["x"]).first().score,
                        np.sum((q - p) * np.log(q / p)), rel_tol=1e-9)
    edges = np.histogram_bin_edges(np.concatenate([a, b]), bins=10)
    ha, hb = np.histogram(a, bins=edges)[0], np.histogram(b, bins=edges)[0]
    e = (ha + hb) / 2 + 1e-10
    assert math.isclose(dr.chi_square_drift(frame(spark, a), frame(spark, b), ["x"]).first().score,
                        np.sum((ha - e) ** 2 / e) / 11, rel_tol=1e-9)


def test_empty_side_is_skipped(spark):
    a = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    for method in dr.METHODS:
        assert [r.feature for r in dr.drift_scores(a, b, method=method).collect()] == ["x"]


def test_constant_reference_bins(spark):
    a, b = frame(spark, [3.0] * 5), frame(spark, [3.0, 4.0])
    assert dr.psi_scores(a, b, ["x"]).first().score > 0


def test_chi_square_normalised(spark):
    x = np.random.default_rng(4).normal(size=200)
    a, b = frame(spark, np.concatenate([x, x])), frame(spark, x)
    assert dr.chi_square_drift(a, b, ["x"]).first().score > 1
    assert dr.chi_square_drift(a, b, ["x"], normalize=True).first().score < 1e-9


def test_verdict_severity(spark):
    s = spark.createDataFrame([("a", 0.5), ("b", 0.01), ("c", 0.3)], "feature string, score double")
    row = dr.drift_verdict(s, 4, 0.1).first()
    assert (row.drifted_features, row.drifted, row.drift_percentage, row.severity) == ("a,c", 2, 0.5, "medium")
    none = dr.drift_verdict(s.where("score < 0.1"), 4, 0.1).first()
    assert (none.drifted_features, none.overall_drift, none.severity) == ("", False, "none")


def test_recent_drift_needs_enough_rows(spark):
    df = spark.range(99).select(F.col("id").alias("ts"), F.when(F.col("id") > 49, 100.0).otherwise(0.0).alias("x"))
    assert dr.recent_drift(df, "ts", ["x"]).first().drift_flag == 0.0
    more = spark.range(100).select(F.col("id").alias("ts"), F.when(F.col("id") > 49, 100.0).otherwise(0.0).alias("x"))
    assert dr.recent_drift(more, "ts", ["x"]).first().drift_flag == 1.0
