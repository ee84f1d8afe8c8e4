"""Drift between a reference and a current sample, and model degradation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from opspark.functions.columns import as_number, bin_index, numeric_columns, safe_ratio
from opspark.operators.ranking import running_totals

METHODS = ("ks", "chi2", "wasserstein", "psi")


def tagged_values(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Both samples as ``(feature, value, side)`` without missing values; side 0 is the reference.

    ``feature`` is the position in ``cols``: a number is cheaper to hash and sort than a name.
    """
    def tall(df, side):
        items = [F.struct(F.lit(i).alias("feature"), as_number(df, c).alias("value")) for i, c in enumerate(cols)]
        return df.select(F.explode(F.array(*items)).alias("r")).select("r.*", F.lit(side).alias("side"))

    return tall(reference, 0).unionByName(tall(current, 1)).where("value is not null")


def side_counts(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per feature and distinct value on either side."""
    return tagged_values(reference, current, cols).groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))


def _ecdf(reference, current, cols):
    """Cumulative counts of both sides at each distinct value."""
    ecdf = running_totals(side_counts(reference, current, cols), ["feature"], "value", ["ref", "cur"], few=len(cols))
    return ecdf.where((F.col("total_ref") > 0) & (F.col("total_cur") > 0))


def _named(scores, cols):
    """Positions back to feature names."""
    return scores.withColumn("feature", F.element_at(F.array(*map(F.lit, cols)), F.col("feature") + 1))


def ks_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic with sample sizes."""
    gap = F.abs(F.col("cum_ref") / F.col("total_ref") - F.col("cum_cur") / F.col("total_cur"))
    return _named(_ecdf(reference, current, cols).groupBy("feature").agg(
        F.max(gap).alias("score"), F.max("total_ref").alias("n_ref"), F.max("total_cur").alias("n_cur")), cols)


def ks_p_value(score, n_ref, n_cur, terms: int = 20):
    """Asymptotic p-value of the two-sample statistic."""
    en = F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    lam = en * score
    total = F.lit(0.0)
    for j in range(1, terms + 1):
        total = total + F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam)
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def wasserstein_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """First Wasserstein distance: area between the two cumulative curves.

    Written as a sum over values, ``sum |F - G| * (next - value)`` needs the next
    value; the gap at a value times ``next - value`` equals the drop form used
    here, in which each value carries the gap before and after itself.
    """
    gap = F.abs(F.col("cum_ref") / F.col("total_ref") - F.col("cum_cur") / F.col("total_cur"))
    before = F.abs((F.col("cum_ref") - F.col("ref")) / F.col("total_ref")
                   - (F.col("cum_cur") - F.col("cur")) / F.col("total_cur"))
    return _named(_ecdf(reference, current, cols).groupBy("feature").agg(
        F.sum(F.col("value") * (before - gap)).alias("score")), cols)


def _binned(reference, current, cols, low, high, bins):
    """Counts per feature and bin on either side, every bin present."""
    ranges = [c for c in cols if low.get(c) is not None and high.get(c) is not None]
    def tall(df, side):
        items = [F.struct(F.lit(c).alias("feature"), bin_index(as_number(df, c), low[c], high[c], bins).alias("bin"))
                 for c in ranges]
        return df.select(F.explode(F.array(*items)).alias("r")).select("r.*", F.lit(side).alias("side"))

    spark = reference.sparkSession
    if not ranges:
        return spark.createDataFrame([], "feature string, bin int, ref bigint, cur bigint")
    both = tall(reference, 0).unionByName(tall(current, 1)).where("bin is not null")
    counts = both.groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))
    grid = spark.createDataFrame([(c, b) for c in ranges for b in range(bins)], "feature string, bin int")
    return F.broadcast(grid).join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", F.coalesce("ref", F.lit(0)).alias("ref"), F.coalesce("cur", F.lit(0)).alias("cur"))


def _extent(df, cols):
    aggs = []
    for i, c in enumerate(cols):
        v = as_number(df, c)
        aggs += [F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"), F.count(v).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"l{i}"], row[f"h{i}"], row[f"n{i}"]) for i, c in enumerate(cols)}


def chi_square_drift(
    reference: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = 10, normalize: bool = False
) -> DataFrame:
    """Binned chi-square over the joint range, divided by the number of bin edges.

    Raw counts by default, so unequal sample sizes show as drift; ``normalize``
    scales the current counts to the reference size.
    """
    a, b = _extent(reference, cols), _extent(current, cols)
    live = [c for c in cols if a[c][2] and b[c][2]]
    low = {c: min(a[c][0], b[c][0]) for c in live}
    high = {c: max(a[c][1], b[c][1]) for c in live}
    cells = _binned(reference, current, live, low, high, bins)
    cur = F.col("cur").cast("double")
    if normalize:
        scale = F.lit(1.0)
        for c in live:
            scale = F.when(F.col("feature") == c, F.lit(a[c][2] / b[c][2])).otherwise(scale)
        cur = cur * scale
    expected = (F.col("ref") + cur) / 2 + F.lit(1e-10)
    part = (F.col("ref") - expected) * (F.col("ref") - expected) / expected
    return cells.groupBy("feature").agg((F.sum(part) / (bins + 1)).alias("score"))


def psi_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index over bins of the reference range.

    One is added to every bin; current rows outside the range count in the
    denominator only.
    """
    a, b = _extent(reference, cols), _extent(current, cols)
    live = [c for c in cols if a[c][2] and b[c][2]]
    cells = _binned(reference, current, live, {c: a[c][0] for c in live}, {c: a[c][1] for c in live}, bins)
    n_ref, n_cur = F.lit(1), F.lit(1)
    for c in live:
        n_ref = F.when(F.col("feature") == c, F.lit(a[c][2])).otherwise(n_ref)
        n_cur = F.when(F.col("feature") == c, F.lit(b[c][2])).otherwise(n_cur)
    r = (F.col("ref") + 1) / (n_ref + bins)
    q = (F.col("cur") + 1) / (n_cur + bins)
    return cells.groupBy("feature").agg(F.sum((q - r) * F.ln(q / r)).alias("score"))


def drift_scores(reference: DataFrame, current: DataFrame, cols: Sequence[str] | None = None,
                 method: str = "ks", label: str = "target") -> DataFrame:
    """``(feature, score)`` by the chosen method."""
    if method not in METHODS:
        raise ValueError(f"unknown drift method: {method}")
    cols = list(cols) if cols is not None else numeric_columns(reference, [label])
    call = {"ks": ks_scores, "chi2": chi_square_drift, "wasserstein": wasserstein_scores, "psi": psi_scores}[method]
    return call(reference, current, cols).select("feature", "score")


def drift_verdict(scores: DataFrame, columns: int, threshold: float = 0.1) -> DataFrame:
    """Drifted features, their share of all numeric columns, flag and severity (one row per feature in)."""
    hit = F.col("score") > threshold
    share = F.count_if(hit) / F.lit(float(columns))
    return scores.agg(
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(hit, F.col("feature"))))).alias("drifted_features"),
        F.count_if(hit).alias("drifted"), (F.count_if(hit) > 0).alias("overall_drift"),
        share.alias("drift_percentage"),
        F.when(F.count_if(hit) == 0, "none").when(share > 0.5, "high").otherwise("medium").alias("severity"))


def last_windows(df: DataFrame, order: str, n: int = 50, tie_break: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows tagged side 1 and the ``n`` before them tagged side 0.

    Of rows of one time those with the greater values of ``tie_break`` count as later. The top-2n limit
    runs on every partition first, so at most 2n rows meet.
    """
    by = [F.col(c).desc() for c in (order, *tie_break)]
    newest = df.orderBy(*by).limit(2 * n)
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*by))
    return newest.withColumn("_place", place).withColumn("side", F.when(F.col("_place") <= n, 1).otherwise(0))


def recent_drift(df: DataFrame, order: str, cols: Sequence[str], n: int = 50, alpha: float = 0.05,
                 share: float = 0.5) -> DataFrame:
    """Dataset drift of the last ``n`` rows against the ``n`` before; zero when rows are short."""
    windows = last_windows(df, order, n, [c for c in cols if c != order]).drop("_place")
    reference = windows.where("side = 0").drop("side")
    current = windows.where("side = 1").drop("side")
    ks = ks_scores(reference, current, cols)
    p = ks_p_value(F.col("score"), F.col("n_ref"), F.col("n_cur"))
    enough = windows.count() >= 2 * n
    drifted = F.count_if((p < alpha) & F.lit(enough))
    return ks.agg(drifted.alias("drifted_columns"),
                  (drifted / F.lit(float(len(cols)))).alias("drift_share"),
                  F.when(drifted >= math.ceil(share * len(cols)), 1.0).otherwise(0.0).alias("drift_flag"))


def accuracy_drop(df: DataFrame, side: str, truth: str, predicted: str, alert: float = 0.05) -> DataFrame:
    """Accuracy and F1 of the reference minus the current side, with the alert."""
    from opspark.operators.evaluate import classification_metrics

    m = classification_metrics(df, truth, predicted, [side])
    def pick(s, c):
        return F.max(F.when(F.col(side) == s, F.col(c)))
    return m.agg(
        pick("reference", "accuracy").alias("reference_accuracy"), pick("current", "accuracy").alias("current_accuracy"),
        (pick("reference", "accuracy") - pick("current", "accuracy")).alias("accuracy_drop"),
        (pick("reference", "f1") - pick("current", "f1")).alias("f1_drop"),
    ).withColumn("alert", F.col("accuracy_drop") > alert)


def error_increase(df: DataFrame, side: str, truth: str, predicted: str, alert: float = 0.1) -> DataFrame:
    """Relative growth of the mean squared error, with the alert."""
    e = F.col(truth).cast("double") - F.col(predicted).cast("double")
    ref = F.avg(F.when(F.col(side) == "reference", e * e))
    cur = F.avg(F.when(F.col(side) == "current", e * e))
    return df.agg(ref.alias("reference_mse"), cur.alias("current_mse"),
                  safe_ratio(cur - ref, ref).alias("mse_increase")).withColumn("alert", F.col("mse_increase") > alert)
