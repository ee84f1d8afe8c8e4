"""Decisions over metric readings: alerts with hold, canary gates, runs, sessions, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.functions.columns import digest_number, key_digest
from opspark.operators.ranking import running_totals
from opspark.operators.scans import CELL_ROWS, largest_group, with_heads
from opspark.operators.store import seconds


def alert_states(readings: DataFrame, by: Sequence[str], at: str, condition: Column, hold: float) -> DataFrame:
    """inactive / pending / firing per evaluation; ``at`` is in seconds.

    ``readings`` is an evaluated series: one row per series and evaluation time.
    """
    w = W.partitionBy(*by).orderBy(at)
    on = F.coalesce(condition, F.lit(False))
    work = readings.withColumn("_on", on).withColumn("_island", F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(w))
    since = F.min(F.when(F.col("_on"), F.col(at))).over(W.partitionBy(*by, "_island"))
    state = (F.when(~F.col("_on"), "inactive")
             .when(F.col(at) - since >= F.lit(hold), "firing").otherwise("pending"))
    return work.withColumn("state", state).drop("_on", "_island")


def canary_gate(readings: DataFrame, by: Sequence[str], at: str, value: str, threshold: float = 0.95,
                count: int = 3) -> DataFrame:
    """Verdict over the last ``count`` readings: all pass, any fail, or inconclusive."""
    w = W.partitionBy(*by).orderBy(at).rowsBetween(-(count - 1), 0)
    v = F.col(value)
    seen = F.count(v).over(w)
    failed = F.sum(F.when(v < threshold, 1).otherwise(0)).over(w)
    verdict = (F.when(failed > 0, "failed").when(seen == count, "successful").otherwise("inconclusive"))
    return readings.withColumn("verdict", verdict)


def analysis_gate(checks: DataFrame, by: Sequence[str], success: str, latency: str, success_min: float = 0.95,
                  latency_max: float = 1000.0, max_failures: int = 3) -> DataFrame:
    """Multi-metric gate: promoted unless more than ``max_failures`` checks fail."""
    bad = ~(F.coalesce((F.col(success) >= success_min) & (F.col(latency) <= latency_max), F.lit(False)))
    n = F.count_if(bad)
    return checks.groupBy(*by).agg(
        F.count("*").alias("checks"), n.alias("failures"),
        F.when(n <= max_failures, "promote").otherwise("rollback").alias("decision"))


def staged_rollout(stages: DataFrame, by: Sequence[str], order: str, passed: str) -> DataFrame:
    """promote / abort / skipped per stage: everything after the first failed gate is skipped."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    ok = F.coalesce(F.col(passed), F.lit(False))
    before = F.coalesce(F.min(ok.cast("int")).over(w), F.lit(1)) == 1
    return stages.withColumn("action", F.when(~before, "skipped").when(ok, "promote").otherwise("abort"))


def error_runs(df: DataFrame, by: Sequence[str], ts: str, is_error: Column, tie_break: Sequence[str] = (),
               min_run: int = 5, eject: int = 30, bucket_seconds: int = 86_400, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Runs of ``min_run`` or more consecutive errors per instance and the end of the ejection.

    Errors of a run share the number of good rows before them. That number is
    summed per time bucket with offsets, so a hot instance is not one task,
    and a run is then a plain aggregate. Where a bucket of an instance is counted to have more than ``cell_rows``
    rows, instances are scanned in cells of equal size instead.
    """
    at = seconds(F.col(ts))
    work = df.select(*by, *tie_break, at.alias("_at"), F.coalesce(is_error, F.lit(False)).alias("_bad"))
    work = work.withColumn("_good", F.when(F.col("_bad"), 0).otherwise(1))
    bucket = F.floor(F.col("_at") / F.lit(float(bucket_seconds)))
    if largest_group(work, [*map(F.col, by), bucket]) > cell_rows:
        rows, series = with_heads(work, by, ["_at", *tie_break], totals=["_good"])
        run = rows.withColumn("cum__good", F.sum("_good").over(series.rowsBetween(W.unboundedPreceding, W.currentRow))).where("_head = 1")
    else:
        run = running_totals(work, by, "_at", ["_good"], bucket=bucket, tie_break=tie_break)
    runs = run.where("_bad").groupBy(*by, "cum__good").agg(
        F.count("*").alias("run_length"), F.min("_at").alias("first_at"), F.max("_at").alias("last_at"))
    return runs.where(F.col("run_length") >= min_run).select(
        *by, "run_length", "first_at", "last_at", (F.col("last_at") + eject).alias("ejected_until"))


def sessions(df: DataFrame, by: Sequence[str], ts: str, gap: int = 3600) -> DataFrame:
    """Sessions closed by ``gap`` seconds or more without activity.

    Events in one gap-wide slot always share a session, so they are folded
    first; the window sees one row per user and slot however busy the user is.
    """
    at = seconds(F.col(ts))
    slots = df.groupBy(*by, F.floor(at / F.lit(float(gap))).alias("_slot")).agg(
        F.min(at).alias("_a"), F.max(at).alias("_b"), F.count("*").alias("_n"))
    w = W.partitionBy(*by).orderBy("_slot")
    new = F.when(F.col("_a") - F.lag("_b").over(w) < gap, 0).otherwise(1)
    marked = slots.withColumn("_new", new).withColumn("session", F.sum("_new").over(w))
    return marked.groupBy(*by, "session").agg(
        F.min("_a").alias("started_at"), F.max("_b").alias("last_seen"), F.sum("_n").alias("events"))


def idle_users(df: DataFrame, by: Sequence[str], ts: str, now: float, timeout: int = 3600, check_every: int = 300) -> DataFrame:
    """Users idle for ``timeout`` seconds at ``now`` and the check at which they are stopped."""
    last = df.groupBy(*by).agg(F.max(seconds(F.col(ts))).alias("last_seen"))
    due = F.ceil((F.col("last_seen") + timeout) / F.lit(float(check_every))) * check_every
    return last.where(F.lit(now) - F.col("last_seen") >= timeout).select(*by, "last_seen", due.alias("stopped_at"))


def traffic_split(key: Column, weight: int = 10, header: Column | None = None, seed: int = 42) -> Column:
    """``v2`` for ``weight`` percent of keys; a header naming a version wins."""
    drawn = F.when(F.pmod(digest_number(key_digest(key, seed)), F.lit(100)) < weight, "v2").otherwise("v1")
    return drawn if header is None else F.coalesce(header, drawn)
