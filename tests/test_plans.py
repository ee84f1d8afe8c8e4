"""Shape of the plans: what must not appear at any size."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from opspark.operators import evaluate as ev, ranking as rk, store as st

CHECKED = [
    "window_features", "drift_ks", "drift_psi", "roc_auc", "split_plain", "split_stratified", "label_encode_names",
    "counter_rate_sliding", "request_kpis", "point_in_time_join", "user_sessions", "error_runs", "require_limits",
    "evidence_tamper_check", "span_breakdown", "impute_median", "remove_outliers_iqr", "target_encode_unknown",
    "duplicate_rows", "missing_ratio", "classification_metrics", "online_lookup", "cost_by_namespace",
]


@pytest.mark.parametrize("name", CHECKED)
def test_no_products_and_no_python(spark, sf, name):
    plan = contract.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for smell in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert smell not in plan, smell


@pytest.mark.parametrize("name", ["missing_ratio", "pearson_matrix", "regression_metrics", "compliance_total"])
def test_one_scan_for_all_columns(spark, sf, name):
    plan = contract.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_scans_read_only_what_is_used(spark, sf):
    plan = contract.queries()["window_features"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "user_id" not in plan


def test_curves_share_one_value_count(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_totalprice")
    out = ev.roc_auc(df, "y", "o_totalprice")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_broadcasts_are_checked(spark):
    from opspark.session import bounded_broadcast

    big = spark.range(1000)
    assert "ResolvedHint" in bounded_broadcast(big, 1000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in bounded_broadcast(big, 999)._jdf.queryExecution().analyzed().toString()


def test_driver_rows_are_bounded(spark):
    from opspark.session import small_rows

    with pytest.raises(ValueError):
        small_rows(spark.range(11), 10)


def test_cluster_needs_a_shared_folder(monkeypatch):
    from opspark import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://cluster", "no such application"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_folder(Session())
