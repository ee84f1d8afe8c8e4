import math

import numpy as np

import pytest
from pyspark.sql import functions as F

from opspark.operators import features as fe, models as mo
from opspark.plans.workflows import fit_features


def test_polynomial_names_and_order():
    terms = [fe.term_name(t) for t in fe.polynomial_terms(["a", "b"], 3)]
    assert terms == ["a", "b", "a^2", "a b", "b^2", "a^3", "a^2 b", "a b^2", "b^3"]
    assert [fe.term_name(t) for t in fe.polynomial_terms(["a", "b", "c"], 2, True)] == ["a", "b", "c", "a b", "a c", "b c"]


def test_polynomial_keeps_text_and_moves_the_label_last(spark):
    df = spark.createDataFrame([(2.0, 1, "x", 3.0)], "a double, target int, s string, b double")
    out = fe.polynomial_features(df, 2)
    assert out.columns == ["a", "b", "a^2", "a b", "b^2", "s", "target"]
    assert tuple(out.first()) == (2.0, 3.0, 4.0, 6.0, 9.0, "x", 1)
    assert fe.polynomial_features(df, 1) is df


def test_cluster_ties_take_the_smallest_number(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 4.0)], "a double, b double")
    rows = fe.cluster_features(df, ["a", "b"], [[1.0, 0.0], [-1.0, 0.0], [3.0, 4.0]]).collect()
    assert [r.cluster for r in rows] == [0, 2] and rows[1].distance_to_cluster_2 == 0.0
    assert fe.fit_clusters(df, ["a"]) is None


def test_label_encoding_round_trip_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    table = fe.categories(df, "s")
    assert {r.category: r.code for r in table.collect()} == {"a": 0, "b": 1, "c": 2}
    out = fe.label_encode(spark.createDataFrame([("c",), ("z",), (None,)], "s string"), "s", table)
    assert sorted(r.s for r in out.collect()) == [-1, -1, 2]


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    fitted = fe.fit_encoders(df, "onehot")
    out = fe.apply_encoders(spark.createDataFrame([("a",), ("q",)], "s string"), fitted)
    assert out.columns == ["s_a", "s_b"] and sorted(tuple(r) for r in out.collect()) == [(0.0, 0.0), (1.0, 0.0)]


def test_one_hot_of_many_classes_is_sparse(spark):
    df = spark.range(100_000).selectExpr("id", "concat('c', id) AS s", "id % 2 AS target")
    fitted = fe.fit_encoders(df, "onehot")
    other = spark.createDataFrame([(1, "c7", 0), (2, "unknown", 1), (3, None, 0)], "id long, s string, target long")
    out = {r.id: r.s_hot for r in fe.apply_encoders(other, fitted).collect()}
    place = sorted(f"c{i}" for i in range(100_000)).index("c7")
    assert tuple(out[1]) == (100_000, [place], [1.0]) and tuple(out[2]) == (100_000, [], []) and tuple(out[3]) == (100_000, [], [])
    assert [tuple(r) for r in fe.sparse_rows(fe.apply_encoders(other, fitted), "id", "s_hot").collect()] == [(1, place, 1.0)]


def test_target_encoding_default_is_the_mean_of_means(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 0.0)], "s string, target double")
    out = fe.target_encode(spark.createDataFrame([("a",), ("z",)], "s string"), "s", fe.fit_target_means(df, "s"))
    assert sorted(r.s for r in out.collect()) == [0.5, 1.0]


def test_encoding_names_are_checked(spark):
    with pytest.raises(ValueError):
        fe.fit_encoders(spark.createDataFrame([("a",)], "s string"), "ordinal")


def test_task_detection(spark):
    many = spark.range(20).select(F.col("id").cast("double").alias("target"))
    assert fe.is_regression(many, "target")
    assert not fe.is_regression(many.select((F.col("target") % 3).alias("target")), "target")
    assert not fe.is_regression(many.select(F.col("target").cast("int").alias("target")), "target")


def test_anova_by_hand(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0), (7.0, 1), (8.0, 1), (9.0, 1)], "x double, target int")
    assert math.isclose(fe.anova_scores(df, ["x"]).first().score, 54.0)


def test_chi_square_falls_back_on_negative_values(spark):
    df = spark.createDataFrame([(-1.0, 0), (2.0, 0), (3.0, 1), (7.0, 1)], "x double, target int")
    assert fe.score_features(df, ["x"], "chi2").first().score == fe.anova_scores(df, ["x"]).first().score


def test_chi_square_by_hand(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 0), (8.0, 1), (8.0, 1)], "x double, target int")
    assert math.isclose(fe.chi_square_scores(df, ["x"]).first().score, (4 - 10) ** 2 / 10 + (16 - 10) ** 2 / 10)


def test_mutual_information_bounds(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("same"), F.lit(1.0).alias("flat"),
                                 (F.col("id") % 2).cast("int").alias("target"))
    got = {r.feature: r.score for r in fe.mutual_information(df, ["same", "flat"]).collect()}
    assert math.isclose(got["same"], math.log(2)) and math.isclose(got["flat"], 0.0, abs_tol=1e-12)


def test_whole_flow_applies_the_same_columns(spark):
    df = spark.range(300).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                 F.concat(F.lit("g"), F.col("id") % 3).alias("s"), (F.col("id") % 2).cast("int").alias("target"))
    flow = fit_features(df, engineering={"n_clusters": 3}, selection={"k_best": 6})
    out = flow.apply(df.limit(50))
    assert out.columns == [*flow.selected, "target"] and len(flow.selected) <= 6 and out.count() == 50


def test_models_save_reload_agree(spark, folder):
    from opspark.sources.sinks import load_latest, save_version, versions

    df = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 10 > 4).cast("int").alias("target"))
    model = mo.fit_forest(df, ["a"], trees=5, max_depth=3)
    stamp = save_version(model, spark, folder)
    again = load_latest(spark, folder)
    assert versions(spark, folder) == [stamp]
    a, b = (mo.score_table(m, df, ["a"], ["id", "target"]) for m in (model, again))
    row = mo.agreement(a.drop("target"), b.drop("target"), "id").first()
    assert row["rows"] == 200 and row["agrees"]
    assert a.where("prediction = target").count() == 200


def test_recursive_elimination_keeps_the_signal(spark):
    df = spark.range(300).select((F.col("id") % 2).cast("double").alias("signal"), ((F.col("id") * 7919) % 101).cast("double").alias("noise"),
                                 ((F.col("id") * 31) % 17).cast("double").alias("more"), (F.col("id") % 2).cast("int").alias("target"))
    assert [c for c, _ in fe.recursive_elimination(df, ["noise", "signal", "more"], keep=1, trees=10)] == ["signal"]


def test_anova_far_from_zero(spark):
    rng = np.random.default_rng(8)
    rows = [(float(v + 0.35 * (i % 2)), i % 2) for i, v in enumerate(rng.normal(size=1000))]
    near = fe.anova_scores(spark.createDataFrame(rows, "x double, target int"), ["x"]).first().score
    far = fe.anova_scores(spark.createDataFrame([(v + 1e9, y) for v, y in rows], "x double, target int"), ["x"]).first().score
    assert near > 10 and math.isclose(near, far, rel_tol=1e-3)
