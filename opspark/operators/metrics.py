"""Service metrics: counters, rates, ratios, bucket quantiles, sliding sums, costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.functions.columns import safe_ratio
from opspark.operators.scans import CELL_ROWS, largest_group, with_heads
from opspark.operators.store import seconds


def matches(col: Column, op: str, value: str) -> Column:
    """Label matcher ``=``, ``!=``, ``=~``, ``!~``; patterns are anchored, a missing label is empty."""
    text = F.coalesce(col, F.lit(""))
    if op == "=":
        return text == value
    if op == "!=":
        return text != value
    if op in ("=~", "!~"):
        hit = text.rlike(f"^(?:{value})$")
        return hit if op == "=~" else ~hit
    raise ValueError(f"unknown matcher: {op}")


def counter_panes(df: DataFrame, labels: Sequence[str], ts: str, value: str, step: int,
                  tie_break: Sequence[str] = (), cell_rows: int = CELL_ROWS) -> DataFrame:
    """Counter samples folded to one row per series and ``step`` seconds.

    A drop of the value is a reset, so the new value itself is the increase.
    Ordering happens inside a pane only, and the step across panes is taken on the
    folded rows, so a hot series spreads over its panes. Where a pane of a series is counted to have more than
    ``cell_rows`` samples, series are scanned in cells of equal size instead.
    """
    labels = list(labels)
    at = seconds(F.col(ts))
    pane = F.floor(at / F.lit(float(step)))
    tagged = df.select(*labels, at.alias("_at"), F.col(value).cast("double").alias("_v"), *tie_break, pane.alias("pane"))
    order = ["_at", *tie_break]
    folded = [
        F.count("*").alias("samples"), F.min("_at").alias("first_at"), F.max("_at").alias("last_at"),
        F.min_by("_v", F.struct(*order)).alias("first_v"), F.max_by("_v", F.struct(*order)).alias("last_v")]
    if largest_group(df, [*map(F.col, labels), pane]) > cell_rows:
        rows, series = with_heads(tagged, labels, order, last=["_v", "pane"])
        grown = rows.withColumn("_inc", _increase(F.col("_v"), F.lag("_v").over(series))).withColumn("_before", F.lag("pane").over(series)).where("_head = 1")
        inner = F.col("_before") == F.col("pane")
        return grown.groupBy(*labels, "pane").agg(
            *folded, F.coalesce(F.sum(F.when(inner, F.col("_inc"))), F.lit(0.0)).alias("inside"),
            F.max(F.when(~inner, F.col("_before"))).alias("prev_pane"), F.max(F.when(~inner, F.col("_inc"))).alias("across"))
    before = F.lag("_v").over(W.partitionBy(*labels, "pane").orderBy(*order))
    grown = tagged.withColumn("_inc", _increase(F.col("_v"), before))
    panes = grown.groupBy(*labels, "pane").agg(*folded, F.coalesce(F.sum("_inc"), F.lit(0.0)).alias("inside"))
    series = W.partitionBy(*labels).orderBy("pane")  # one row per pane, not per sample
    return panes.withColumn("prev_pane", F.lag("pane").over(series)).withColumn(
        "across", _increase(F.col("first_v"), F.lag("last_v").over(series)))


def _increase(now: Column, before: Column) -> Column:
    return F.when(now < before, now).otherwise(now - before)


def window_rates(panes: DataFrame, labels: Sequence[str], step: int, span: int) -> DataFrame:
    """Increase and per-second rate over ``span`` seconds, evaluated every ``step`` seconds.

    ``span`` is a multiple of ``step``. A rate needs two samples; it is the
    increase over the time between the first and the last sample.
    """
    if span % step:
        raise ValueError("span must be a multiple of step")
    reach = span // step
    spread = panes.withColumn("_w", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(reach)), lambda i: F.col("pane") + i)))
    crossing = F.when(F.col("prev_pane") >= F.col("_w") - reach, F.col("across"))
    grown = F.sum("inside") + F.coalesce(F.sum(crossing), F.lit(0.0))
    out = spread.groupBy(*labels, "_w").agg(
        grown.alias("increase"), F.sum("samples").alias("samples"),
        F.min("first_at").alias("_a"), F.max("last_at").alias("_b"))
    rate = F.when(F.col("samples") >= 2, safe_ratio(F.col("increase"), F.col("_b") - F.col("_a")))
    return out.select(*labels, (F.col("_w") * step).alias("eval_at"), "samples", "increase", rate.alias("rate"))


def counter_rate(df: DataFrame, labels: Sequence[str], ts: str, value: str, span: int,
                 step: int | None = None, tie_break: Sequence[str] = (), cell_rows: int = CELL_ROWS) -> DataFrame:
    """Reset-aware rate per series over sliding (or, without a step, tumbling) windows."""
    step = step or span
    return window_rates(counter_panes(df, labels, ts, value, step, tie_break, cell_rows), labels, step, span)


def sum_by(df: DataFrame, labels: Sequence[str], value: str, out: str = "total") -> DataFrame:
    """Sum across series by the given labels."""
    return df.groupBy(*labels).agg(F.sum(value).alias(out))


def average_by(df: DataFrame, labels: Sequence[str], value: str, out: str = "average") -> DataFrame:
    """Average across series by the given labels."""
    return df.groupBy(*labels).agg(F.avg(value).alias(out))


def vector_ratio(df: DataFrame, by: Sequence[str], top: Column, value: Column, out: str = "ratio") -> DataFrame:
    """``sum by(..)(matching) / sum by(..)(all)`` in one pass.

    A label set with no matching series gives no row, as a division of two
    vectors does.
    """
    sums = df.groupBy(*by).agg(F.sum(F.when(top, value)).alias("_t"), F.sum(value).alias("_b"))
    return sums.where(F.col("_t").isNotNull()).select(*by, safe_ratio(F.col("_t"), F.col("_b")).alias(out))


def share(df: DataFrame, by: str, value: str, out: str = "share") -> DataFrame:
    """Each label's part of the whole."""
    sums = df.groupBy(by).agg(F.sum(value).cast("double").alias("_s"))
    return sums.select(by, safe_ratio(F.col("_s"), sums.agg(F.sum("_s")).scalar()).alias(out))


def bucket_counts(df: DataFrame, by: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative ``le`` buckets per group from raw values, with the ``+Inf`` bucket, in one aggregate."""
    ends = [float(b) for b in bounds] + [float("inf")]
    row = df.groupBy(*by).agg(*[
        F.count_if(F.col(value) <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(ends)])
    items = [F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(ends)]
    return row.select(*by, F.explode(F.array(*items)).alias("r")).select(*by, "r.*")


def bucket_quantile(buckets: DataFrame, by: Sequence[str], q: float, value: str = "count",
                    out: str = "quantile") -> DataFrame:
    """Quantile from cumulative buckets, linear inside a bucket.

    The first bucket starts at zero; a rank in the ``+Inf`` bucket gives the
    highest finite bound. Windows run over the buckets of a group only.
    """
    anchor = list(by) or [F.lit(0)]
    w = W.partitionBy(*anchor).orderBy("le")
    work = buckets.select(
        *by, "le", F.col(value).cast("double").alias("_c"),
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("_from"),
        F.coalesce(F.lag(F.col(value).cast("double")).over(w), F.lit(0.0)).alias("_before"),
        F.max(F.col(value).cast("double")).over(W.partitionBy(*anchor)).alias("_all"))
    rank = F.lit(q) * F.col("_all")
    inside = F.col("_from") + (F.col("le") - F.col("_from")) * F.try_divide(
        rank - F.col("_before"), F.col("_c") - F.col("_before"))
    point = F.when(F.col("le") == float("inf"), F.col("_from")).otherwise(inside)
    hit = work.where((F.col("_all") > 0) & (F.col("_c") >= rank)).withColumn("_q", point)
    return hit.groupBy(*by).agg(F.min_by("_q", "le").alias(out))


def sliding_sums(df: DataFrame, by: Sequence[str], ts: str, measures: dict[str, Column], step: int, span: int) -> DataFrame:
    """Sums over ``span`` seconds ending every ``step`` seconds.

    Rows are first summed per step, so only the step sums are repeated for the
    windows they fall in, never the rows.
    """
    reach = span // step
    pane = F.floor(seconds(F.col(ts)) / F.lit(float(step)))
    panes = df.groupBy(*by, pane.alias("_p")).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    spread = panes.withColumn("_w", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(reach)), lambda i: F.col("_p") + i)))
    out = spread.groupBy(*by, "_w").agg(*[F.sum(n).alias(n) for n in measures])
    return out.select(*by, (F.col("_w") * step).alias("eval_at"), *measures)


def last_value(df: DataFrame, by: Sequence[str], ts: str, value: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Last non-null value of each series."""
    order = F.struct(F.col(ts), *[F.col(t) for t in tie_break])
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(value, order).alias("last_value"))


def tier(ratio: Column) -> Column:
    """Stat colour: green from 0.99, yellow from 0.95, red below, N/A without data."""
    return (F.when(ratio.isNull(), "N/A").when(ratio >= 0.99, "green")
            .when(ratio >= 0.95, "yellow").otherwise("red"))


def above(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """The series whose value is over the threshold."""
    return df.where(F.col(value) > threshold)


def scenario_costs(df: DataFrame, scenario: str, hours: str, rate: str, baseline: str) -> DataFrame:
    """Monthly cost per scenario and the percentage saved against the baseline."""
    priced = df.select(scenario, hours, rate, (F.col(hours) * F.col(rate)).alias("monthly_cost"))
    base = priced.where(F.col(scenario) == baseline).agg(F.max("monthly_cost")).scalar()
    return priced.withColumn("savings_percent", F.try_divide((base - F.col("monthly_cost")) * 100, base))


# The cost log line.
COST_PATTERN = r"namespace=(\S+)\s+cost=(\S+)"


def parse_cost_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """``namespace`` and ``cost`` of matching log lines; an unreadable cost is 0."""
    cost = F.expr(f"try_cast(regexp_extract(`{line}`, '{COST_PATTERN}', 2) AS double)".replace("\\", "\\\\"))
    space = F.regexp_extract(F.col(line), COST_PATTERN, 1)
    rest = [F.col(c) for c in df.columns if c != line]
    return df.where(F.col(line).rlike(COST_PATTERN)).select(
        *rest, space.alias("namespace"), F.coalesce(cost, F.lit(0.0)).alias("cost"))


def cost_by_namespace(df: DataFrame, ts: str, width: str = "1 day") -> DataFrame:
    """Cost per namespace and time window."""
    return df.groupBy(F.window(F.col(ts).cast("timestamp"), width).alias("w"), "namespace").agg(
        F.sum("cost").alias("cost")).select("namespace", F.col("w.start").alias("window_start"), "cost")


def fold_requests(df: DataFrame, by: Sequence[str], ts: str, status: str, latency: str, bounds: Sequence[float],
                  step: int = 30) -> DataFrame:
    """Requests folded to counts per group and ``step`` seconds; also the body of the streaming job."""
    pane = F.window(F.col(ts).cast("timestamp") if not df.isStreaming else F.col(ts), f"{step} seconds")
    return df.groupBy(pane.alias("w"), *by).agg(
        F.count("*").alias("requests"), F.count_if(matches(F.col(status), "=~", "2..")).alias("ok"),
        F.count_if(matches(F.col(status), "=~", "5..")).alias("failed"),
        *[F.count_if(F.col(latency) <= F.lit(float(b))).alias(f"le{i}") for i, b in enumerate(bounds)],
    ).select(F.unix_seconds("w.start").alias("pane_start"), *by, "requests", "ok", "failed",
             *[f"le{i}" for i in range(len(bounds))])


def kpis_from_panes(panes: DataFrame, by: Sequence[str], bounds: Sequence[float], step: int = 30, span: int = 300,
                    q: float = 0.99) -> DataFrame:
    """Request rate, success and error ratio and latency quantile over ``span`` seconds every ``step``."""
    ends = [float(b) for b in bounds]
    names = ["requests", "ok", "failed", *[f"le{i}" for i in range(len(ends))]]
    spread = panes.withColumn("eval_at", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(span // step)), lambda i: F.col("pane_start") + i * step)))
    sums = spread.groupBy(*by, "eval_at").agg(*[F.sum(n).alias(n) for n in names])
    items = [F.struct(F.lit(b).alias("le"), F.col(f"le{i}").alias("c")) for i, b in enumerate(ends)]
    rank = F.lit(q) * F.col("requests")
    steps = F.array(*items)
    # buckets of a row are an array of fixed length, so the quantile is row-local
    below = F.filter(steps, lambda s: s["c"] < rank)
    reached = F.filter(steps, lambda s: s["c"] >= rank)
    prev_le = F.coalesce(F.try_element_at(below, F.lit(-1))["le"], F.lit(0.0))
    prev_c = F.coalesce(F.try_element_at(below, F.lit(-1))["c"], F.lit(0))
    hit = F.try_element_at(reached, F.lit(1))
    point = prev_le + (hit["le"] - prev_le) * F.try_divide(rank - prev_c, (hit["c"] - prev_c).cast("double"))
    quantile = F.when(F.size(reached) > 0, point).otherwise(F.lit(ends[-1]))
    return sums.select(
        *by, "eval_at", (F.col("requests") / F.lit(float(span))).alias("request_rate"),
        safe_ratio(F.col("ok"), F.col("requests")).alias("success_rate"),
        safe_ratio(F.col("failed"), F.col("requests")).alias("error_rate"), quantile.alias("latency_quantile"))


def request_kpis(df: DataFrame, by: Sequence[str], ts: str, status: str, latency: str, bounds: Sequence[float],
                 step: int = 30, span: int = 300, q: float = 0.99) -> DataFrame:
    """KPIs straight from a request log."""
    return kpis_from_panes(fold_requests(df, by, ts, status, latency, bounds, step), by, bounds, step, span, q)
