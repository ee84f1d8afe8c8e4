import math

import pytest
from pyspark.sql import functions as F

from opspark.operators import profile as pf


@pytest.fixture()
def small(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, None, "b"), (3, float("nan"), None), (3, 4.0, "a"), (3, 4.0, "a")], "id int, x double, s string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_missing_counts_nan_and_null(small):
    got = {r.column: r.missing_ratio for r in pf.missing_ratio(small).collect()}
    assert got == {"x": 0.4, "s": 0.2}


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert pf.duplicate_count(df).first()[0] == 2
    assert rows(pf.explode_copies(pf.duplicate_rows(df), block=1)) == [(1, None), (1, None)]


def test_no_duplicates_is_zero_even_when_empty(spark):
    assert pf.duplicate_count(spark.createDataFrame([], "a int")).first()[0] == 0


def test_outliers_skip_constant_and_clean_columns(spark):
    df = spark.createDataFrame([(float(i), 5.0, i) for i in range(20)] + [(1000.0, 5.0, 3)], "a double, b double, c int")
    assert [(r.column, r.outliers) for r in pf.outlier_counts(df).collect()] == [("a", 1)]
    assert [(r.column, r.outliers) for r in pf.outlier_counts(df, "zscore", 3).collect()] == [("a", 1)]
    with pytest.raises(ValueError):
        pf.outlier_counts(df, "isolation_forest")


def test_unique_counts_ignore_missing(small):
    assert {r.column: r.unique_count for r in pf.unique_counts(small).collect()} == {"id": 3, "x": 2, "s": 2}


def test_schema_errors(small):
    assert pf.schema_errors(small, {"id": "int", "x": "float", "s": "string"}) == []
    errors = pf.schema_errors(small, {"id": "string", "y": "int"})
    assert len(errors) == 2 and "y" in errors[0] and "'id'" in errors[1]


def test_expectations(small):
    got = {(r.column, r.expectation): (r.unexpected, r.success) for r in pf.expectations(small).collect()}
    assert got[("x", "not_null")] == (2, False)
    assert got[("id", "unique")] == (3, False)
    assert ("x", "unique") not in got


def test_verdict(spark, small):
    bad = pf.verdict(small).first()
    assert (bad.error_count, bad.validation_passed) == (1, False)
    good = pf.verdict(spark.createDataFrame([(1,), (2,)], "a int")).first()
    assert (good.error_count, good.validation_passed) == (0, True)


def test_id_heuristic_also_hits_width(spark):
    from opspark.functions.columns import id_columns

    df = spark.createDataFrame([(1, 1, 1)], "user_ID int, width int, name int")
    assert id_columns(df) == ["user_ID", "width"]


def test_quality_score(small):
    got = {(r.type, r.column): r.amount for r in pf.quality_issues(small).collect()}
    assert got == {("high_missing_values", "x"): 0.4, ("high_missing_values", "s"): 0.2, ("duplicate_ids", "id"): 2.0}
    score = pf.quality_score(small).first()
    assert math.isclose(score.quality_score, 0.7) and score.alert


def test_spearman_of_monotone_is_one(spark):
    df = spark.createDataFrame([(float(i), float(i) ** 3, float(-i)) for i in range(50)], "a double, b double, c double")
    got = {(r.left, r.right): r.spearman for r in pf.spearman_matrix(df, ["a", "b", "c"]).collect()}
    assert math.isclose(got[("a", "b")], 1.0) and math.isclose(got[("a", "c")], -1.0)


def test_validation_is_one_wide_scan(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = pf.missing_ratio(li)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Python" not in plan


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert pf.histogram(df, "x", 10).where("rows > 0").count() == 1
