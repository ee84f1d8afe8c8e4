"""Evaluation of predictions: every metric is built from small counted tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.functions.columns import bin_index, digest_number, safe_ratio
from opspark.operators.quantiles import exact_quantiles
from opspark.operators.ranking import running_totals
from opspark.session import bounded_broadcast, cut_lineage, small_rows, spread


def confusion_cells(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, prediction) pair: the only pass over the data."""
    return df.groupBy(*by, F.col(truth).alias("y"), F.col(predicted).alias("p")).agg(F.count("*").alias("rows"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts for every pair of labels seen on either side, zeros included; null is a label of its own.

    The grid has a row per pair of labels by definition; it is laid out by Spark from the label table.
    """
    cells = confusion_cells(df, truth, predicted)
    labels = cells.select("y").union(cells.select("p")).distinct()
    # every label meets the set of labels, which explodes in the tasks
    grid = labels.withColumn("ps", labels.agg(F.collect_list(F.struct("y"))).scalar())
    grid = grid.select("y", F.explode("ps").alias("q")).select("y", F.col("q.y").alias("p"))
    cells = cells.select(F.col("y").alias("_y"), F.col("p").alias("_p"), "rows")
    met = grid.join(cells, F.col("y").eqNullSafe(F.col("_y")) & F.col("p").eqNullSafe(F.col("_p")), "left")
    return met.select("y", "p", F.coalesce("rows", F.lit(0)).alias("rows"))


def class_report(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label; zero when a denominator is zero."""
    cells = confusion_cells(df, truth, predicted, by)
    sides = [F.struct(F.col("y").alias("label"), F.col("rows").alias("s"), F.lit(0).cast("bigint").alias("f"),
                      F.when(F.col("y") == F.col("p"), F.col("rows")).otherwise(0).alias("t")),
             F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("s"), F.col("rows").alias("f"),
                      F.lit(0).cast("bigint").alias("t"))]
    tall = cells.select(*by, F.explode(F.array(*sides)).alias("r")).select(*by, "r.*")
    per = tall.groupBy(*by, "label").agg(F.sum("s").alias("support"), F.sum("f").alias("_f"), F.sum("t").alias("_t"))
    zero = F.lit(0.0)
    precision = F.coalesce(safe_ratio(F.col("_t"), F.col("_f")), zero)
    recall = F.coalesce(safe_ratio(F.col("_t"), F.col("support")), zero)
    f1 = F.coalesce(safe_ratio(2 * F.col("_t"), F.col("_f") + F.col("support")), zero)
    return per.select(*by, "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
                      "support", F.col("_t").alias("hits"))


def report_averages(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro and weighted rows of the class report."""
    w = F.col("support").cast("double")
    total = F.sum(w)

    def weighted(c):
        return F.sum(F.col(c) * w) / total

    row = report.groupBy(*by).agg(
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    items = [F.struct(F.lit(n).alias("label"), F.col(f"{p}_precision").alias("precision"),
                      F.col(f"{p}_recall").alias("recall"), F.col(f"{p}_f1").alias("f1"), F.col("support"))
             for n, p in (("macro avg", "m"), ("weighted avg", "w"))]
    return row.select(*by, F.explode(F.array(*items)).alias("r")).select(*by, "r.*")


def classification_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy with weighted precision, recall and F1."""
    report = class_report(df, truth, predicted, by)
    w = F.col("support").cast("double")
    return report.groupBy(*by).agg(
        (F.sum("hits") / F.sum(w)).alias("accuracy"), (F.sum(F.col("precision") * w) / F.sum(w)).alias("precision"),
        (F.sum(F.col("recall") * w) / F.sum(w)).alias("recall"), (F.sum(F.col("f1") * w) / F.sum(w)).alias("f1"))


def threshold_counts(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Cumulative true and false positives per distinct score, highest score first."""
    counts = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg"))
    return running_totals(counts, [], "score", ["pos", "neg"], descending=True).select(
        "score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.col("total_pos").alias("all_pos"), F.col("total_neg").alias("all_neg"))


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One (fpr, tpr) point per distinct score; the curve starts at (0, 0)."""
    return threshold_counts(df, truth, score).select(
        F.col("score").alias("threshold"), safe_ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("all_pos")).alias("tpr"))


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids.

    A point's predecessor is known from the counts of the point itself, so each
    trapezoid is row-local and the area a plain sum.
    """
    t = threshold_counts(df, truth, score)
    height = F.col("tp") - F.col("pos") / 2
    area = F.sum(F.col("neg") * height) / F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return t.agg(area.alias("auc_roc"))


def pr_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Precision and recall per distinct score; the end point (recall 0, precision 1) has no score."""
    points = threshold_counts(df, truth, score).select(
        F.col("score").alias("threshold"), safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("all_pos")).alias("recall"))
    last = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(last)


def pr_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under precision over recall by trapezoids, from the same row-local predecessors."""
    t = threshold_counts(df, truth, score)
    here = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.coalesce(safe_ratio(tp0, tp0 + fp0), F.lit(1.0))
    step = safe_ratio(F.col("pos"), F.col("all_pos"))
    return t.agg(F.sum(step * (here + before) / 2).alias("auc_pr"))


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, R2, explained variance and residual moments in one scan."""
    y = F.col(truth).cast("double")
    e = y - F.col(predicted).cast("double")
    mse = F.avg(e * e)
    return df.groupBy(*by).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(F.when(e.isNotNull(), y)))).alias("r2"),
        (1 - F.try_divide(F.var_pop(e), F.var_pop(F.when(e.isNotNull(), y)))).alias("explained_variance"),
        F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"))


def error_percentiles(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Median, 90th and 95th percentile of the absolute error."""
    err = F.abs(F.col(truth).cast("double") - F.col(predicted).cast("double"))
    q = exact_quantiles(df, {"e": err}, [0.5, 0.9, 0.95])["e"]
    return df.sparkSession.createDataFrame(
        [tuple(q)], "median_absolute_error double, percentile_90_error double, percentile_95_error double")


def _log_factorial(k: Column) -> Column:
    """ln(k!): exact products up to 20, the series behind Stirling's formula beyond, whose next term is below 1e-15."""
    x = k.cast("double")
    tail = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return F.when(k <= 20, F.ln(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))).otherwise(
        x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + tail)


def poisson_draws(cells: DataFrame, keys: Sequence[str], count: str, draws: int, seed: int) -> DataFrame:
    """(columns of cells, draw, w): for each cell and draw a Poisson number with mean ``count``, which is the weight that so many rows of
    weight Poisson(1) have together.

    A 60-bit number from the digest of keys, draw and seed is looked up in the distribution, which is summed within nine deviations of
    the mean (less than 1e-17 lies outside). Cells of one count share its distribution; its steps are spread over as many equal slices of
    [0, 1], so that a draw meets about two of them. Work is cells times draws, however many rows a cell has.
    """
    mean = F.col(count).cast("double")
    reach = 9 * F.sqrt(mean) + 20
    low, high = F.greatest(F.lit(0), F.floor(mean - reach)).cast("bigint"), F.ceil(mean + reach).cast("bigint")
    slices = (high - low + 2).cast("double")
    sizes = cells.select(mean.alias("_mean"), low.alias("_low"), high.alias("_high"), slices.alias("_slices")).distinct()
    k = F.col("_k")
    apart = (k - F.col("_mean")) / F.col("_mean")
    # around the mean by the gap to it, so that large means lose no digits
    far = k * F.ln(F.col("_mean")) - F.col("_mean") - _log_factorial(k)
    near = k * F.log1p(apart) * -1 + (k - F.col("_mean")) - 0.5 * F.ln(2 * math.pi * k) - 1 / (12 * k.cast("double"))
    share = F.exp(F.when(F.col("_mean") > 1e6, near).otherwise(far))
    order = W.partitionBy("_mean").orderBy("_k")
    upto = F.when(k <= F.col("_high"), F.sum(share).over(order)).otherwise(2.0)
    steps = sizes.withColumn("_k", F.explode(F.sequence("_low", F.col("_high") + 1))).withColumn("_upto", upto)
    steps = steps.withColumn("_above", F.lag("_upto", 1, -1.0).over(order))
    first, last = (F.floor(F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)) * F.col("_slices")) for c in ("_above", "_upto"))
    # a step of no width holds no draw
    steps = cut_lineage(steps.where("_above < _upto").select("_mean", "_k", "_above", "_upto", F.explode(F.sequence(first, last)).alias("_slice")))
    name = F.concat_ws("-", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys], F.col("draw").cast("string"), F.lit(str(seed)))
    u = digest_number(F.md5(name.cast("binary")), 15) / F.lit(float(1 << 60))
    asked = spread(cells).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).select(
        *cells.columns, "draw", u.alias("_u"), mean.alias("_mean"), slices.alias("_slices"))
    asked = asked.withColumn("_slice", F.floor(F.col("_u") * F.col("_slices")))
    met = asked.join(bounded_broadcast(steps), ["_mean", "_slice"]).where("_above < _u and _u <= _upto")
    return met.select(*cells.columns, "draw", F.col("_k").alias("w"))


#: Rows of one number range that are numbered together.
NUMBERED = 1000

#: Hex digits that one weight is read from, and weights that one SHA-256 digest gives.
WEIGHT_DIGITS, WEIGHTS_A_DIGEST = 16, 4


def weight_bounds() -> list[str]:
    """The sums of the Poisson(1) distribution as hex fractions: a weight is the number of bounds that are not above its digits.

    They go on until a sum is one within the digits, so no weight that the digits can tell is left out.
    """
    with localcontext(prec=60):
        bounds, total, share = [], Decimal(0), (-Decimal(1)).exp()
        while (at := math.ceil((total := total + share) * 16**WEIGHT_DIGITS)) < 16**WEIGHT_DIGITS:
            bounds.append(f"{at:0{WEIGHT_DIGITS}x}")
            share /= len(bounds)
    return bounds


def weighted_draws(rows: DataFrame, keys: Sequence[str], draws: int, seed: int) -> DataFrame:
    """(columns of rows, draw, w): every row once per draw with a Poisson(1) weight of its own.

    ``rows`` has a column ``n``, the number of rows that are equal in ``keys``; they are numbered, so each of them has its own weights. Work
    is rows times draws, in as many tasks as a shuffle has, however the rows came.
    """
    conf = rows.sparkSession.conf
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(conf.get("spark.sql.shuffle.partitions")))
    n, at = F.col("n"), F.col("_range") * NUMBERED
    ranges = rows.withColumn("_range", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / NUMBERED)))).repartition(tasks)
    single = ranges.withColumn("_row", F.explode(F.sequence(at + 1, F.least(n, at + NUMBERED))))
    blocks = single.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(-(-draws // WEIGHTS_A_DIGEST) - 1))))
    name = F.concat_ws("-", *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys], *[F.col(c).cast("string") for c in ("_row", "_block")], F.lit(str(seed)))
    parts = [F.substring("_hex", 1 + WEIGHT_DIGITS * i, WEIGHT_DIGITS) for i in range(WEIGHTS_A_DIGEST)]
    tall = blocks.withColumn("_hex", F.sha2(name.cast("binary"), 256)).select(*rows.columns, "_block", F.posexplode(F.array(*parts)).alias("_place", "_digits"))
    bounds = weight_bounds()
    weight = F.when(F.col("_digits") < bounds[0], 0)
    for w, bound in enumerate(bounds[1:], 1):
        weight = weight.when(F.col("_digits") < bound, w)
    draw = F.col("_block") * WEIGHTS_A_DIGEST + F.col("_place") + 1
    return tall.select(*rows.columns, draw.alias("draw"), weight.otherwise(len(bounds)).cast("bigint").alias("w")).where(F.col("draw") <= draws)


def _intervals(per_draw: DataFrame, metrics: Sequence[str], confidence: float) -> DataFrame:
    """Mean, deviation and percentile bounds over the draws (one row per draw, so small)."""
    alpha = 1 - confidence
    bounds = F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"a_{m}"), F.stddev_pop(m).alias(f"s_{m}"), F.percentile(m, bounds).alias(f"b_{m}")]
    row = per_draw.agg(*aggs)
    items = [F.struct(F.lit(m).alias("metric"), F.col(f"a_{m}").alias("mean"), F.col(f"s_{m}").alias("std"),
                      F.col(f"b_{m}")[0].alias("lower"), F.col(f"b_{m}")[1].alias("upper")) for m in metrics]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def bootstrap_classification(
    df: DataFrame, truth: str, predicted: str, draws: int = 1000, confidence: float = 0.95, seed: int = 42, key: Sequence[str] = ()
) -> DataFrame:
    """Confidence intervals of accuracy and weighted F1 over Poisson resamples of the scored rows.

    Every row has a weight of its own in every draw, from the digest of its ``key``, truth and prediction and its number among rows that
    are equal in these.
    """
    rows = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)], F.col(truth).alias("y"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    cells = weighted_draws(rows, rows.columns[:-1], draws, seed).where("w > 0").groupBy("draw", "y", "p").agg(F.sum("w").alias("c"))
    sides = [F.struct(F.col("y").alias("label"), F.col("c").alias("s"), F.lit(0).cast("bigint").alias("f"),
                      F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0).alias("t")),
             F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("s"), F.col("c").alias("f"),
                      F.lit(0).cast("bigint").alias("t"))]
    tall = cells.select("draw", F.explode(F.array(*sides)).alias("r")).select("draw", "r.*")
    per = tall.groupBy("draw", "label").agg(F.sum("s").alias("s"), F.sum("f").alias("f"), F.sum("t").alias("t"))
    f1 = F.coalesce(safe_ratio(2 * F.col("t"), F.col("f") + F.col("s")), F.lit(0.0))
    total = F.sum("s").cast("double")
    per_draw = per.groupBy("draw").agg((F.sum("t") / total).alias("accuracy"),
                                       (F.sum(f1 * F.col("s")) / total).alias("f1"))
    return _intervals(per_draw, ["accuracy", "f1"], confidence)


def bootstrap_regression(
    df: DataFrame, truth: str, predicted: str, draws: int = 1000, confidence: float = 0.95, seed: int = 42, grid: int | None = None
) -> DataFrame:
    """Confidence intervals of RMSE and R2 over Poisson resamples of the scored rows.

    Only rows of the same truth and prediction are counted together, so nothing is left out: such a cell's weight in a draw is one
    Poisson number with its count as the mean. Rows without truth or prediction are left out.

    A ``grid`` asks for an approximation instead: rows are summed per cell of so many equal bins of the truth and as many of the error.
    What rows of such a cell differ among themselves is then missing in the intervals; a column ``inside`` tells that share of the variance
    of the squared errors.
    """
    y, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    slim = df.select(y.alias("y"), p.alias("p"), (y - p).alias("g")).where("y is not null and g is not null")
    edge = cut_lineage(slim.agg(F.min("y").alias("a"), F.max("y").alias("b"), F.min("g").alias("c"), F.max("g").alias("d"), F.avg("y").alias("m")))
    keys = {"y": F.col("y"), "p": F.col("p")} if grid is None else {
        "i": bin_index(F.col("y"), F.col("a"), F.col("b"), grid), "j": bin_index(F.col("g"), F.col("c"), F.col("d"), grid)}
    # centred first: the spread of values far from zero is not lost in their squares
    near, e2 = F.col("y") - F.col("m"), F.col("g") * F.col("g")
    cells = cut_lineage(slim.join(F.broadcast(edge)).groupBy(*(v.alias(k) for k, v in keys.items())).agg(
        F.count("*").alias("n"), F.sum(e2).alias("e"), F.sum(near).alias("s"), F.sum(near * near).alias("q"), F.sum(e2 * e2).alias("e4")))
    share = F.col("w") / F.col("n")
    sums = poisson_draws(cells, list(keys), "n", draws, seed).groupBy("draw").agg(
        F.sum("w").cast("double").alias("n"), F.sum(share * F.col("e")).alias("e"), F.sum(share * F.col("s")).alias("s"), F.sum(share * F.col("q")).alias("q"))
    n = F.col("n")
    per_draw = sums.where("n > 0").select("draw", F.sqrt(F.col("e") / n).alias("rmse"),
                                          (1 - F.try_divide(F.col("e"), F.col("q") - F.col("s") * F.col("s") / n)).alias("r2"))
    out = _intervals(per_draw, ["rmse", "r2"], confidence)
    if grid is None:
        return out
    inside = F.try_divide(F.sum(F.col("e4") - F.col("e") * F.col("e") / F.col("n")), F.sum("e4") - F.sum("e") * F.sum("e") / F.sum("n"))
    return out.withColumn("inside", cells.agg(F.greatest(F.coalesce(inside, F.lit(0.0)), F.lit(0.0)).alias("v")).scalar())


def score_summary(scores: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Mean and population deviation per metric over the folds."""
    return scores.groupBy(metric).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
