"""Order-based building blocks that never sort a whole group in one task.

* ``running_totals``: cumulative sums over a total order. Rows are cut into
  buckets by value, summed inside the bucket, and shifted by the bucket offset.
* ``hash_rank`` / ``rank_cutoffs``: ranks in the order of a key digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from opspark.functions.columns import key_digest


#: Most keys whose value cuts are sent to all tasks.
MAX_FEW_KEYS = 10_000


#: Cuts between two coarse cuts, when a value is looked up among many.
COARSE = 64


def _bucket_count(df: DataFrame) -> int:
    """As many buckets as shuffle partitions, the number that is set for the size of the data."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    bucket: Column | None = None,
    descending: bool = False,
    tie_break: Sequence[str] = (),
    few: int | None = None,
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive) and ``total_<m>`` per key in the order of ``order``.

    ``bucket`` must be monotone in ``order``; without it the values are cut at
    approximate quantiles of ``order`` per key, which needs the keys to be few
    (column names, sides) and rows to be already summed per distinct value.
    ``few`` tells the number of keys where the caller knows it; the cuts are then
    made within the same query and share its shuffle.
    """
    keys = list(keys)
    if bucket is None:
        tagged = _quantile_bucket(df, keys, order, few)
    else:
        tagged = df.withColumn("_bucket", bucket)

    def direction(name):
        return F.col(name).desc() if descending else F.col(name).asc()

    inside = W.partitionBy(*keys, "_bucket").orderBy(direction(order), *[direction(t) for t in tie_break])
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    per_bucket = tagged.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    anchor = keys or [F.lit(0)]
    before = W.partitionBy(*anchor).orderBy(direction("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*anchor)
    offsets = per_bucket.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_bucket").alias("_k_bucket"),
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )
    summed = tagged
    for m in measures:
        summed = summed.withColumn(f"_in_{m}", F.sum(m).over(inside))
    on = F.col("_bucket").eqNullSafe(F.col("_k_bucket"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = summed.join(offsets, on)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"total_{m}") for m in measures],
    )


def _quantile_bucket(df: DataFrame, keys: list[str], order: str, few: int | None = None) -> DataFrame:
    """Tag rows with the bucket their value falls in, cut at sketched quantiles."""
    buckets = _bucket_count(df)
    if not keys and isinstance(df.schema[order].dataType, T.StringType):
        return _text_bucket(df, order, buckets)
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    number = F.col(order).cast("double")
    sketch = F.percentile_approx(number, probs, F.lit(max(1000, buckets * 10)))
    if not keys:
        # a scalar subquery: evaluated once, on the same shuffle as the rows
        marked = df.withColumn("_edges", _two_levels(df.agg(sketch.alias("e"))).scalar())
        return _by_edges(marked, number, df.columns)
    if few is None:
        few = df.select(*keys).distinct().limit(MAX_FEW_KEYS + 1).count()
    edges = df.groupBy(*[F.col(k).alias(f"_e_{k}") for k in keys]).agg(sketch.alias("e"))
    edges = _two_levels(edges, *[f"_e_{k}" for k in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys])
    # one row per key: sent to all tasks while the keys are few, joined by shuffle beyond
    return _by_edges(df.join(F.broadcast(edges) if few <= MAX_FEW_KEYS else edges, on, "left"), number, df.columns)


def _two_levels(edges: DataFrame, *keys: str) -> DataFrame:
    """The cuts ``e`` with every COARSE-th of them apart, as one struct ``_edges``."""
    fine = F.coalesce(F.col("e").cast("array<double>"), F.array().cast("array<double>"))
    coarse = F.filter(fine, lambda x, i: i % COARSE == COARSE - 1)
    return edges.select(*keys, F.struct(fine.alias("fine"), coarse.alias("coarse")).alias("_edges"))


def _by_edges(df: DataFrame, number: Column, columns) -> DataFrame:
    """Tag rows with the number of cuts below the value: coarse cuts first, then the cuts between two of them."""
    # a key without cuts, or a null value, falls in the first bucket
    skipped = F.coalesce(F.size(F.filter("_edges.coarse", lambda e: e < number)), F.lit(0)) * COARSE
    met = F.filter(F.slice("_edges.fine", F.col("_skip") + 1, COARSE), lambda e: e < number)
    found = F.when(F.col("_edges").isNull(), 0).otherwise(F.col("_skip") + F.size(met))
    return df.withColumn("_skip", F.when(F.col("_edges").isNull(), 0).otherwise(skipped)).withColumn("_bucket", found).select(*columns, "_bucket")


def _text_bucket(df: DataFrame, order: str, buckets: int, per_bucket: int = 20) -> DataFrame:
    """Cut distinct texts at a bounded bottom-k hash sample, the same one on every run."""
    sample = df.select(order).orderBy(F.xxhash64(order)).limit(buckets * per_bucket)
    edges = sorted(r[0] for r in sample.collect() if r[0] is not None)[per_bucket::per_bucket]
    cut = F.array(*map(F.lit, ["", *edges]))
    return df.withColumn("_bucket", F.size(F.filter(cut, lambda e: e < F.col(order))))


def hash_rank(df: DataFrame, groups: Sequence[str], key: str, seed: int | str, name: str = "rank") -> DataFrame:
    """Rank rows of a group by ``md5(key-seed)``, one task per digest prefix.

    The digest is uniform, so the 65 536 prefixes split any group evenly, and
    the offset table holds at most that many rows per group.
    """
    work = df.withColumn("_digest", key_digest(F.col(key), seed)).withColumn("_one", F.lit(1).cast("bigint"))
    work = running_totals(work, groups, "_digest", ["_one"], bucket=F.substring("_digest", 1, 4), tie_break=[key])
    return work.select(*df.columns, F.col("cum__one").alias(name), F.col("total__one").alias(f"{name}_total"))


def rank_cutoffs(df: DataFrame, group: str | None, key: str, seed, ranks: dict) -> dict:
    """For each group the (digest, key) pair found at the given digest ranks.

    ``ranks`` maps a group value to a list of 1-based ranks. Only the rows in
    the digest prefixes holding a cut are ordered, so wide rows never move.
    """
    spark = df.sparkSession
    label = F.col(group).cast("string") if group else F.lit("all")
    slim = df.select(label.alias("g"), F.col(key).alias("k"), key_digest(F.col(key), seed).alias("d"))
    prefix = F.substring("d", 1, 4)
    counts = slim.groupBy("g", prefix.alias("p")).agg(F.count("*").alias("c"))
    cum = counts.withColumn("cum", F.sum("c").over(W.partitionBy("g").orderBy("p")))
    wanted_rows = [(g, i, int(r)) for g, rs in ranks.items() for i, r in enumerate(rs) if r > 0]
    if not wanted_rows:
        return {}
    wanted = spark.createDataFrame(wanted_rows, "g string, i int, r long")
    near = (
        cum.join(F.broadcast(wanted.withColumnRenamed("g", "wg")), F.col("g").eqNullSafe(F.col("wg")))
        .where((F.col("cum") >= F.col("r")) & (F.col("cum") - F.col("c") < F.col("r")))
        .select("g", "p", "i", (F.col("r") - (F.col("cum") - F.col("c"))).alias("need"))
    )
    cuts = spark.createDataFrame(
        [(r["g"], r["p"], r["i"], r["need"]) for r in near.collect()], "wg string, wp string, i int, need long")
    hit = slim.join(F.broadcast(cuts), F.col("g").eqNullSafe(F.col("wg")) & (prefix == F.col("wp")))
    place = F.row_number().over(W.partitionBy("g", "i").orderBy("d", "k"))
    found = hit.withColumn("place", place).where(F.col("place") == F.col("need"))
    return {(r["g"], r["i"]): (r["d"], r["k"]) for r in found.collect()}
