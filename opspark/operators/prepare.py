"""Preparing a table: missing values, outliers, scaling and splits.

``fit_*`` runs aggregates and returns a small fitted dict; ``apply_*`` is a pure
projection or filter, usable on batches and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.functions.columns import (
    as_number, is_missing, key_digest, keyed_uniform, numeric_columns, string_columns, z_score,
)
from opspark.operators.profile import iqr_bounds, moments
from opspark.operators.quantiles import exact_quantiles
from opspark.operators.ranking import hash_rank, rank_cutoffs
from opspark.session import small_rows

#: Labels above this many are split by distributed ranks instead of cut-offs.
MAX_STRATA = 1000


def drop_missing(df: DataFrame) -> DataFrame:
    """Keep the rows without any missing value."""
    keep = F.lit(True)
    for c in df.columns:
        keep = keep & ~is_missing(df, c)
    return df.where(keep)


def drop_report(df: DataFrame) -> DataFrame:
    """Rows kept and rows dropped by ``drop_missing``, in one scan."""
    bad = F.lit(False)
    for c in df.columns:
        bad = bad | is_missing(df, c)
    return df.agg(F.count_if(~bad).alias("rows_kept"), F.count_if(bad).alias("rows_dropped"))


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, the smallest one on ties."""
    if not cols:
        return {}
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("v")) for c in cols]
    tall = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.v").where("v is not null")
    counts = tall.groupBy("column", "v").agg(F.count("*").alias("c"))
    best = counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("c"), F.col("v"))).alias("v"))
    found = {r["column"]: r["v"] for r in small_rows(best)}
    return {c: found.get(c) for c in cols}


def fit_imputer(df: DataFrame, method: str = "median") -> dict:
    """Fill values: mean or median for numbers, the mode for strings.

    A ``mode`` request fills numbers with the median, as ``median`` does.
    """
    if method not in ("mean", "median", "mode"):
        raise ValueError(f"unknown imputation method: {method}")
    nums = numeric_columns(df)
    if method == "mean":
        fill = {c: m[0] for c, m in moments(df, nums).items()}
    else:
        fill = {c: q[0] for c, q in exact_quantiles(df, {c: as_number(df, c) for c in nums}, [0.5]).items()}
    fill.update(modes(df, string_columns(df)))
    return fill


def apply_imputer(df: DataFrame, fill: dict) -> DataFrame:
    """Put the fitted values where a value is missing; numbers become doubles."""
    nums = set(numeric_columns(df))
    cols = []
    for c in df.columns:
        if c in fill and fill[c] is not None:
            base = as_number(df, c) if c in nums else F.col(f"`{c}`")
            cols.append(F.coalesce(base, F.lit(fill[c])).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols)


def knn_impute(
    df: DataFrame, key: str, cols: Sequence[str], k: int = 5, cell_rows: int = 256
) -> DataFrame:
    """Fill gaps with the mean of the ``k`` nearest rows holding the value, exactly.

    Distance is Euclidean over the coordinates both rows have, scaled by
    total / common coordinates; ties go to the smaller key; a row sharing no
    coordinate with any donor takes the column mean. Donors with equal
    coordinates are cut to their ``k`` smallest keys first (the others can
    never be chosen), then packed in cells along their coordinates. Each gap
    visits only the cells whose closest possible distance is not above the
    distance within which ``k`` donors are sure to lie, so no gap-by-donor
    product is formed and the result is that of a full search.
    """
    from opspark.operators.neighbours import nearest_means

    base = df.select(F.col(key), *[as_number(df, c).alias(c) for c in cols])
    mean_of = {c: m[0] for c, m in moments(df, cols).items()}
    filled = df
    gaps = base.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    for target in cols:
        if not gaps[target]:
            continue
        others = [c for c in cols if c != target]
        near = nearest_means(base, key, target, others, len(cols), k, cell_rows)
        near = near.select(F.col("_key").alias("_near_key"), F.col("_fill"))
        filled = filled.join(near, F.col(key) == F.col("_near_key"), "left")
        value = F.coalesce(as_number(df, target), F.col("_fill"), F.lit(mean_of[target]).cast("double"))
        filled = filled.select(*[value.alias(c) if c == target else F.col(f"`{c}`") for c in df.columns])
    return filled


def fit_outliers(df: DataFrame, method: str = "iqr", threshold: float = 1.5, label: str = "target",
                 cols: Sequence[str] | None = None) -> dict:
    """Fences or moments for every numeric column but the label, over the whole table."""
    cols = list(cols) if cols is not None else numeric_columns(df, [label])
    if method == "none":
        return {"method": "none"}
    if method == "iqr":
        return {"method": "iqr", "threshold": threshold, "columns": iqr_bounds(df, cols, threshold)}
    if method == "zscore":
        return {"method": "zscore", "threshold": threshold, "columns": moments(df, cols)}
    raise ValueError(f"unknown outlier method: {method}")


def apply_outliers(df: DataFrame, fitted: dict) -> DataFrame:
    """Keep the inliers. The fence test keeps missing values, the z-score test drops them."""
    if fitted["method"] == "none":
        return df
    keep = F.lit(True)
    for c, stats in fitted["columns"].items():
        v = as_number(df, c)
        if fitted["method"] == "iqr":
            keep = keep & F.coalesce(v.between(F.lit(stats[0]), F.lit(stats[1])), F.lit(True))
        else:
            std = F.lit(stats[1]).cast("double")
            keep = keep & F.coalesce(
                z_score(v, F.lit(stats[0]).cast("double"), std) <= F.lit(fitted["threshold"]), F.lit(False))
    return df.where(keep)


def fit_scaler(df: DataFrame, robust: bool = False, label: str = "target",
               cols: Sequence[str] | None = None) -> dict[str, tuple[float, float]]:
    """Centre and scale: mean and population deviation, or median and quartile range."""
    cols = list(cols) if cols is not None else numeric_columns(df, [label])
    if robust:
        q = exact_quantiles(df, {c: as_number(df, c) for c in cols}, [0.25, 0.5, 0.75])
        raw = {c: (v[1], v[2] - v[0]) for c, v in q.items() if v[1] is not None}
    else:
        raw = {c: (m[0], m[2]) for c, m in moments(df, cols).items() if m[0] is not None}
    return {c: (centre, spread if spread else 1.0) for c, (centre, spread) in raw.items()}


def apply_scaler(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Subtract the centre and divide by the scale."""
    return df.select(*[
        ((as_number(df, c) - F.lit(fitted[c][0])) / F.lit(fitted[c][1])).alias(c) if c in fitted else F.col(f"`{c}`")
        for c in df.columns])


def _sizes(n: int, test: float, val: float) -> tuple[int, int]:
    return int(n * test + 0.5), int(n * val + 0.5)


def split(
    df: DataFrame, key: str, label: str | None = None, test: float = 0.2, val: float = 0.1, seed: int = 42,
    name: str = "split", max_strata: int = MAX_STRATA,
) -> DataFrame:
    """Tag rows train / validation / test with exact sizes, stratified by the label.

    Rows are taken in the order of ``md5(key-seed)`` within each label: first
    the test share, then the validation share. A label too rare to stratify
    (a class of one row, or fewer test rows than classes) turns it off.
    """
    if label is not None:
        counts = df.groupBy(F.col(label).alias("g")).agg(F.count("*").alias("c"))
        sizes = counts.agg(F.count("*").alias("k"), F.min("c").alias("m"), F.sum("c").alias("n"),
                           F.count_if(F.col("g").isNull()).alias("nulls")).first()
        plain = sizes["k"] == 0 or sizes["m"] < 2 or sizes["n"] * test < sizes["k"] or sizes["nulls"] > 0
        if plain:
            return split(df, key, None, test, val, seed, name)
        if sizes["k"] > max_strata:
            ranked = hash_rank(df, [label], key, seed, "_rank")
            return _by_rank(ranked, df.columns, test, val, name)
        per = {str(r["g"]): _sizes(r["c"], test, val)
               for r in counts.select(F.col("g").cast("string").alias("g"), "c").collect()}
    else:
        per = {"all": _sizes(df.count(), test, val)}
    cuts = rank_cutoffs(df, label, key, seed, {g: [t, t + v] for g, (t, v) in per.items()})
    rows = []
    key_type = df.schema[key].dataType.simpleString()
    for g in per:
        first, second = cuts.get((g, 0)), cuts.get((g, 1))
        rows.append((g, *(first or ("", None)), *(second or ("", None))))
    work = df.withColumn("_digest", key_digest(F.col(key), seed))
    if label is None:
        ends = [F.lit(rows[0][1]), F.lit(rows[0][2]).cast(key_type), F.lit(rows[0][3]), F.lit(rows[0][4]).cast(key_type)]
    else:
        table = df.sparkSession.createDataFrame(
            rows, f"_g string, _d0 string, _k0 {key_type}, _d1 string, _k1 {key_type}")
        # one row per label, at most max_strata of them
        work = work.join(F.broadcast(table), F.col(label).cast("string") == F.col("_g"), "left")
        ends = [F.col(c) for c in ("_d0", "_k0", "_d1", "_k1")]

    def upto(d, k):
        return (F.col("_digest") < d) | ((F.col("_digest") == d) & (F.col(key) <= k))

    tag = F.when(upto(*ends[:2]), "test").when(upto(*ends[2:]), "validation").otherwise("train")
    return work.select(*[F.col(f"`{c}`") for c in df.columns], tag.alias(name))


def _by_rank(ranked: DataFrame, columns, test: float, val: float, name: str) -> DataFrame:
    n = F.col("_rank_total")
    t = F.floor(n * test + 0.5)
    v = F.floor(n * val + 0.5)
    tag = F.when(F.col("_rank") <= t, "test").when(F.col("_rank") <= t + v, "validation").otherwise("train")
    return ranked.select(*[F.col(f"`{c}`") for c in columns], tag.alias(name))


def folds(df: DataFrame, key: str, label: str | None = None, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Stratified fold numbers 0..k-1: the digest rank within the label, modulo ``k``."""
    ranked = hash_rank(df, [label] if label else [], key, seed, "_rank")
    return ranked.select(*df.columns, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int").alias(name))


def split_overlap(df: DataFrame, key: str, name: str = "split") -> DataFrame:
    """Keys found in more than one part of a split (none, if the split is right)."""
    per = df.groupBy(key).agg(F.count_distinct(name).alias("parts"))
    return per.agg(F.count_if(F.col("parts") > 1).alias("shared_keys"))


def noisy_score(col: Column, key: Column, seed: int = 7) -> Column:
    """``x * 0.5`` plus uniform noise fixed by the key."""
    return col * 0.5 + keyed_uniform(key, seed)


def shifted_score(col: Column) -> Column:
    """``(x + 1) * 0.42``."""
    return (col + 1) * 0.42
