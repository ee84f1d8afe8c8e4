import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.operators import prepare as pr
from opspark.plans.workflows import prepare_table
from opspark.sources.state import load_state, save_state


@pytest.fixture(scope="module")
def sample(spark):
    """A thousand rows with gaps and two injected extremes."""
    rng = np.random.default_rng(42)
    f1 = rng.normal(0, 1, 1000)
    f2 = rng.normal(5, 2, 1000)
    rows = []
    for i in range(1000):
        a = None if i % 10 == 7 else float(f1[i])
        rows.append((i, a, float(f2[i]), "ABC"[int(rng.integers(3))], float(rng.uniform(0, 100)), int(rng.integers(2))))
    rows[0] = (0, 100.0, *rows[0][2:])
    rows[1] = (1, rows[1][1], -100.0, *rows[1][3:])
    return spark.createDataFrame(rows, "row int, feature_1 double, feature_2 double, feature_3 string, feature_4 double, target int")


def test_drop_missing_leaves_none(sample):
    kept = pr.drop_missing(sample)
    assert kept.where("feature_1 is null").count() == 0
    report = pr.drop_report(sample).first()
    assert (report.rows_kept, report.rows_dropped) == (900, 100)


@pytest.mark.parametrize("method", ["mean", "median", "mode"])
def test_impute_keeps_the_row_count(sample, method):
    fill = pr.fit_imputer(sample, method)
    out = pr.apply_imputer(sample, fill)
    assert out.count() == 1000 and out.where("feature_1 is null").count() == 0
    x = [r[0] for r in sample.where("feature_1 is not null").select("feature_1").collect()]
    assert math.isclose(fill["feature_1"], np.mean(x) if method == "mean" else np.median(x), rel_tol=1e-9)


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert pr.modes(df, ["s"]) == {"s": "a"}


def test_unknown_methods_are_rejected(sample):
    with pytest.raises(ValueError):
        pr.fit_imputer(sample, "magic")
    with pytest.raises(ValueError):
        pr.fit_outliers(sample, "isolation_forest")


def test_fences_remove_the_extremes_and_keep_missing(sample):
    out = pr.apply_outliers(sample, pr.fit_outliers(sample, "iqr", 1.5, cols=["feature_1", "feature_2"]))
    ends = out.agg(F.max("feature_1"), F.min("feature_2")).first()
    assert ends[0] < 100 and ends[1] > -100
    one = pr.apply_outliers(sample, pr.fit_outliers(sample, "iqr", 1.5, cols=["feature_1"]))
    assert one.where("feature_1 is null").count() == 100


def test_zscore_drops_missing_and_constants(spark, sample):
    out = pr.apply_outliers(sample, pr.fit_outliers(sample, "zscore", 3, cols=["feature_1"]))
    assert out.where("feature_1 is null").count() == 0
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert pr.apply_outliers(flat, pr.fit_outliers(flat, "zscore", 3)).count() == 0


def test_scaling(sample):
    out = pr.apply_scaler(sample, pr.fit_scaler(sample, cols=["feature_2", "feature_4"]))
    m = out.agg(F.avg("feature_2"), F.stddev_pop("feature_2"), F.avg("feature_4"), F.stddev_pop("feature_4")).first()
    assert abs(m[0]) < 1e-9 and math.isclose(m[1], 1) and abs(m[2]) < 1e-9 and math.isclose(m[3], 1)


def test_constant_scales_to_zero(spark):
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.x for r in pr.apply_scaler(flat, pr.fit_scaler(flat)).collect()] == [0.0, 0.0]


def test_split_sizes_and_disjointness(sample):
    out = pr.split(sample, "row", "target")
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert abs(sizes["test"] - 200) <= 2 and abs(sizes["validation"] - 100) <= 2 and sum(sizes.values()) == 1000
    assert pr.split_overlap(out, "row").first()[0] == 0
    per = {(r["split"], r["target"]): r["count"] for r in out.groupBy("split", "target").count().collect()}
    ones = sample.where("target = 1").count()
    assert per[("test", 1)] == int(ones * 0.2 + 0.5)


def test_split_paths_agree(sample):
    a = {r.row: r["split"] for r in pr.split(sample, "row", "target").collect()}
    b = {r.row: r["split"] for r in pr.split(sample, "row", "target", max_strata=1).collect()}
    assert a == b


def test_split_falls_back_when_a_class_is_single(spark):
    df = spark.range(100).select("id", F.when(F.col("id") == 5, "rare").otherwise("common").alias("y"))
    a = {r.id: r["split"] for r in pr.split(df, "id", "y").collect()}
    b = {r.id: r["split"] for r in pr.split(df, "id").collect()}
    assert a == b


def test_split_does_not_move_the_wide_rows(sample):
    plan = pr.split(sample, "row", "target")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_folds_are_balanced(sample):
    got = [r["count"] for r in pr.folds(sample, "row", "target").groupBy("target", "fold").count().collect()]
    assert max(got) - min(got) <= 60 and len(got) == 10


def knn_brute(rows, cols, k):
    """Full search over all rows: the result every pruned search has to give."""
    mean = {c: np.mean([r[c] for r in rows if r[c] is not None]) for c in cols}
    out = {}
    for r in rows:
        for c in cols:
            if r[c] is not None:
                continue
            scored = []
            for d in rows:
                if d[c] is None:
                    continue
                both = [o for o in cols if o != c and r[o] is not None and d[o] is not None]
                if both:
                    scored.append((len(cols) * sum((r[o] - d[o]) ** 2 for o in both) / len(both), d["k"], d[c]))
            best = sorted(scored)[:k]
            out[(r["k"], c)] = np.mean([b[2] for b in best]) if best else mean[c]
    return out


@pytest.mark.parametrize("cell_rows", [5, 40, 5000])
def test_knn_matches_full_search(spark, cell_rows):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        values = [float(v) for v in (*rng.normal(size=2), rng.integers(0, 4))]
        if i % 3 == 0:  # a third of all rows are copies
            values = [0.5, 0.5, float(i % 5)]
        if i % 7 == 0:
            values[int(rng.integers(3))] = None
        if i == 70:
            values = [None, None, None]
        rows.append({"k": i, "a": values[0], "b": values[1], "c": values[2]})
    df = spark.createDataFrame([(r["k"], r["a"], r["b"], r["c"]) for r in rows], "k int, a double, b double, c double")
    want = knn_brute(rows, "abc", 5)
    got = {r.k: r for r in pr.knn_impute(df, "k", ["a", "b", "c"], 5, cell_rows).collect()}
    for (k, c), v in want.items():
        assert math.isclose(got[k][c], v, rel_tol=1e-9, abs_tol=1e-9), (k, c)
    assert len(got) == 300


def test_knn_over_many_coordinates(spark):
    from opspark.operators import neighbours

    rng = np.random.default_rng(6)
    cols = [f"c{i}" for i in range(13)]
    centres = rng.normal(size=(8, 13)) * 20
    rows = []
    for i in range(240):
        values = (centres[i % 8] + rng.normal(size=13) * 0.1).tolist()
        if i % 40 == 0:
            values[0] = None
        rows.append({"k": i, **dict(zip(cols, values))})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k int, " + ", ".join(f"{c} double" for c in cols))
    want = knn_brute(rows, cols, 5)
    got = {r.k: r for r in pr.knn_impute(df, "k", cols, 5, 20).collect()}
    assert all(math.isclose(got[k][c], v, rel_tol=1e-9) for (k, c), v in want.items()) and want
    plan = neighbours.nearest_means(df, "k", "c0", cols[1:], 13, 5, 20)
    assert plan.count() == 6


def test_leaves_seen_by_a_gap_do_not_grow_with_the_donors(spark):
    from opspark.operators import neighbours

    def spot(seed, c):
        return (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(c)), F.lit(1 << 30)) / float(1 << 30)).alias(c)

    seen, sizes = [], []
    gaps = spark.range(200).select(F.col("id").alias("_key"), spot(1, "a"), spot(1, "b"))
    for many in (5_000, 100_000):
        donors = spark.range(many).select(F.col("id").alias("_donor"), F.col("id").cast("double").alias("_value"), spot(2, "a"), spot(2, "b"))
        levels, placed = neighbours.partition_tree(donors, ["a", "b"], 64)
        sizes.append(placed.groupBy("node").count().agg(F.max("count"), F.count("*"), F.sum("count")).first())
        seen.append(neighbours.leaf_visits(gaps, levels, ["a", "b"], 5).count() / 200)
    assert all(s[0] <= 64 for s in sizes) and sizes[1][1] > 1500 and [s[2] for s in sizes] == [5_000, 100_000]
    assert seen[1] < 1.5 * seen[0] < 40


def test_whole_preparation(sample, spark, folder):
    from opspark.sources.sinks import write_splits

    done = prepare_table(sample, "row", "target")
    write_splits(done.table, f"{folder}/parts")
    back = spark.read.parquet(f"{folder}/parts")
    assert {r["split"] for r in back.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert back.where("feature_1 is null or feature_3 is null").count() == 0
    assert done.applied == ["missing_values: median", "outliers: iqr", "normalized_features"]
    save_state(spark, done.state, f"{folder}/state")
    again = load_state(spark, f"{folder}/state")
    assert math.isclose(again["scaler"]["feature_4"][0], done.state["scaler"]["feature_4"][0])


def test_fit_on_train_only(sample):
    whole = prepare_table(sample, "row", "target")
    train = prepare_table(sample, "row", "target", fit_on="train")
    assert whole.state["scaler"]["feature_4"] != train.state["scaler"]["feature_4"]
    m = train.part("train").agg(F.avg("feature_4")).first()[0]
    assert abs(m) < 1e-9


def test_preparation_with_drop_and_knn(sample):
    assert prepare_table(sample, "row", "target", {"handle_missing": "drop", "outlier_method": "none"}).table.count() == 900
    knn = prepare_table(sample, "row", "target", {"handle_missing": "knn", "outlier_method": "none", "normalize": False})
    assert knn.table.where("feature_1 is null").count() == 0 and knn.table.count() == 1000


def test_noise_is_fixed_by_the_key(spark):
    df = spark.range(100).select("id", pr.noisy_score(F.lit(0.0), F.col("id")).alias("s"))
    a, b = [r.s for r in df.orderBy("id").collect()], [r.s for r in df.repartition(7).orderBy("id").collect()]
    assert a == b and all(0 <= v < 1 for v in a) and len(set(a)) > 90
