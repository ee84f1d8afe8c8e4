"""Feature engineering: polynomials, cluster distances, encodings, selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opspark.functions.columns import as_number, numeric_columns, string_columns
from opspark.operators.quantiles import exact_quantiles
from opspark.operators.ranking import running_totals
from opspark.session import bounded_broadcast, cut_lineage

#: One-hot columns are made up to so many categories; beyond, a category is a place in a sparse vector.
MAX_ONE_HOT = 2000


# -- polynomials -------------------------------------------------------------

def polynomial_terms(cols: Sequence[str], degree: int, interaction_only: bool = False) -> list[tuple[str, ...]]:
    """Column tuples of every term up to ``degree``, lower degrees first, no constant."""
    pick = combinations if interaction_only else combinations_with_replacement
    return [term for n in range(1, degree + 1) for term in pick(cols, n)]


def term_name(term: Sequence[str]) -> str:
    """``a``, ``a^2``, ``a b`` ..."""
    parts = []
    for c in dict.fromkeys(term):
        power = term.count(c) if isinstance(term, tuple) else list(term).count(c)
        parts.append(c if power == 1 else f"{c}^{power}")
    return " ".join(parts)


def polynomial_features(
    df: DataFrame, degree: int = 2, interaction_only: bool = False, label: str = "target",
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Polynomial terms of the numeric columns, then the other columns, then the label."""
    if degree <= 1:
        return df
    cols = list(cols) if cols is not None else numeric_columns(df, [label])
    if not cols:
        return df
    exprs = []
    for term in polynomial_terms(cols, degree, interaction_only):
        exprs.append(reduce(lambda a, b: a * b, [as_number(df, c) for c in term]).alias(term_name(term)))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in cols and c != label]
    tail = [F.col(label)] if label in df.columns else []
    return df.select(*exprs, *rest, *tail)


# -- clusters ----------------------------------------------------------------

def fit_clusters(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42, max_iter: int = 20):
    """K-means centres over the numeric columns; None when there are fewer than two."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    if len(cols) < 2:
        return None
    named = df.select(*[as_number(df, c).alias(f"x{i}") for i, c in enumerate(cols)]).na.drop("any")
    ready = VectorAssembler(inputCols=[f"x{i}" for i in range(len(cols))], outputCol="v").transform(named).select("v")
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="v").fit(ready)
    # numbered in order, so that the numbers do not depend on the draw
    return sorted([float(x) for x in c] for c in model.clusterCenters())


def distance(values: Sequence[Column], centre: Sequence[float]) -> Column:
    """Euclidean distance of a row to one centre."""
    return F.sqrt(reduce(lambda a, b: a + b, [(v - F.lit(float(c))) * (v - F.lit(float(c)))
                                              for v, c in zip(values, centre)]))


def cluster_features(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest centre (smallest number on ties) and the distance to every centre.

    Centres are literals, so this is a projection with no join.
    """
    values = [as_number(df, c) for c in cols]
    dist = [distance(values, c).alias(f"distance_to_cluster_{i}") for i, c in enumerate(centres)]
    out = df.select(*[F.col(f"`{c}`") for c in df.columns], *dist)
    names = [f"distance_to_cluster_{i}" for i in range(len(centres))]
    label = F.array_position(F.array(*names), F.least(*names) if len(names) > 1 else F.col(names[0])) - 1
    return out.withColumn("cluster", label.cast("int"))


def array_distance(vec: Column, centre: Column) -> Column:
    """Euclidean distance between two equally long arrays."""
    gaps = F.zip_with(vec, centre, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))


# -- encodings ---------------------------------------------------------------

def categories(df: DataFrame, col: str) -> DataFrame:
    """Sorted classes with codes 0..k-1, as ``(category, code)``.

    Codes are running counts over the distinct classes, so neither the driver
    nor one task has to hold them all. The table is written down, so that it is worked out once.
    """
    seen = df.select(F.col(col).alias("category")).where("category is not null").distinct()
    coded = running_totals(seen.withColumn("_one", F.lit(1)), [], "category", ["_one"])
    return cut_lineage(coded.select("category", (F.col("cum__one") - 1).cast("int").alias("code")))


def label_encode(df: DataFrame, col: str, table: DataFrame) -> DataFrame:
    """Replace a category by its code, -1 when unknown."""
    return _lookup(df, col, table, "code", F.lit(-1))


def _lookup(df: DataFrame, col: str, table: DataFrame, value: str, default: Column) -> DataFrame:
    """Left lookup of ``col`` in ``(category, value)`` with a default."""
    side = bounded_broadcast(table.select(F.col("category").alias("_cat"), F.col(value).alias("_val")))
    joined = df.join(side, F.col(col) == F.col("_cat"), "left")
    return joined.select(*[F.coalesce("_val", default).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def one_hot(df: DataFrame, col: str, classes: Sequence) -> DataFrame:
    """One 0/1 column per class named ``<col>_<class>``; an unknown value is all zeros."""
    flags = [F.when(F.col(col) == F.lit(c), 1.0).otherwise(0.0).alias(f"{col}_{c}") for c in classes]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != col], *flags)


def sparse_one_hot(df: DataFrame, col: str, table: DataFrame, size: int) -> DataFrame:
    """``<col>_hot`` in place of ``col``: a sparse vector of ``size`` places as a struct (size, indices, values).

    ``table`` has (category, code). Missing and unknown values have no place set. Any number of categories will do: the table is joined.
    """
    out = _lookup(df, col, table, "code", F.lit(-1))
    met = F.col(f"`{col}`") >= 0
    hot = F.struct(
        F.lit(size).alias("size"), F.when(met, F.array(F.col(f"`{col}`"))).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(met, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != col], hot.alias(f"{col}_hot"))


def sparse_rows(df: DataFrame, key: str, col: str) -> DataFrame:
    """The long form of a sparse column: (key, place, value) of what is set."""
    at = F.explode(F.arrays_zip(f"{col}.indices", f"{col}.values"))
    return df.select(key, at.alias("c")).select(key, F.col("c.indices").alias("place"), F.col("c.values").alias("value"))


def fit_target_means(df: DataFrame, col: str, label: str = "target") -> DataFrame:
    """Mean label per category as ``(category, mean)``."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("category")).agg(F.avg(label).alias("mean"))


def target_encode(df: DataFrame, col: str, means: DataFrame) -> DataFrame:
    """Replace a category by its mean label; unknown ones get the plain mean of the means."""
    default = means.agg(F.avg("mean").alias("m")).first()["m"]
    return _lookup(df, col, means, "mean", F.lit(default).cast("double"))


def fit_encoders(df: DataFrame, method: str = "target", label: str = "target") -> dict:
    """Fitted encodings for every string column.

    A column's entry is a table: (category, mean) for ``target``, (category, code) for ``label``, and for ``onehot`` the classes as
    a list up to ``MAX_ONE_HOT`` of them, beyond that the (category, code) table with its number of rows.
    """
    if method not in ("onehot", "label", "target"):
        raise ValueError(f"unknown encoding: {method}")
    cols = string_columns(df, [label])
    fitted: dict = {"method": method, "columns": {}}
    for c in cols:
        if method == "onehot":
            table = categories(df, c)
            size = table.count()
            fitted["columns"][c] = [r["category"] for r in table.orderBy("code").collect()] if size <= MAX_ONE_HOT else (table, size)
        elif method == "label":
            fitted["columns"][c] = categories(df, c)
        elif label in df.columns:
            fitted["columns"][c] = cut_lineage(fit_target_means(df, c, label))
    return fitted


def apply_encoders(df: DataFrame, fitted: dict) -> DataFrame:
    """Encode every fitted column."""
    for c, table in fitted["columns"].items():
        if fitted["method"] == "onehot":
            df = one_hot(df, c, table) if isinstance(table, list) else sparse_one_hot(df, c, *table)
        elif fitted["method"] == "label":
            df = label_encode(df, c, table)
        else:
            df = target_encode(df, c, table)
    return df


# -- selection ---------------------------------------------------------------

def is_regression(df: DataFrame, label: str) -> bool:
    """A floating label with more than ten values means regression."""
    if not isinstance(df.schema[label].dataType, (T.FloatType, T.DoubleType)):
        return False
    return df.select(label).distinct().limit(11).count() > 10


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population variance per column from one scan."""
    from opspark.operators.profile import long_form

    row = df.agg(*[F.var_pop(as_number(df, c)).alias(f"v{i}") for i, c in enumerate(cols)])
    return long_form(row, cols, {"variance": "v"}, "feature")


def keep_varying(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> list[str]:
    """Columns whose population variance is above the threshold."""
    kept = {r["feature"] for r in variances(df, cols).where(F.col("variance") > threshold).collect()}
    return [c for c in cols if c in kept]


def _class_moments(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(feature, n, s, m, v) per class: values, their sum, mean and population variance.

    Mean and variance are merged from partials by their stable form, so values far from zero lose no digits.
    """
    aggs = []
    for i, c in enumerate(cols):
        v = as_number(df, c)
        aggs += [F.count(v).cast("double").alias(f"n{i}"), F.sum(v).alias(f"s{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    per_class = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("y")).agg(F.count("*").cast("double").alias("rows"), *aggs)
    items = [F.struct(F.lit(c).alias("feature"), "rows", *(F.col(f"{k}{i}").alias(k) for k in "nsmv")) for i, c in enumerate(cols)]
    return per_class.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def chi_square_scores(df: DataFrame, cols: Sequence[str], label: str = "target") -> DataFrame:
    """Class sums of a feature against what the class shares predict."""
    tall = _class_moments(df, cols, label).select("feature", "rows", "s")
    total = tall.groupBy(F.col("feature").alias("_f")).agg(F.sum("s").alias("_s"), F.sum("rows").alias("_n"))
    expected = F.col("_s") * F.col("rows") / F.col("_n")
    gap = F.col("s") - expected
    # one row per class and feature meets one row per feature
    return tall.join(total, F.col("feature") == F.col("_f")).groupBy("feature").agg(F.sum(F.try_divide(gap * gap, expected)).alias("score"))


def anova_scores(df: DataFrame, cols: Sequence[str], label: str = "target") -> DataFrame:
    """Between-class over within-class variance per feature."""
    tall = _class_moments(df, cols, label).where("n > 0")
    total = tall.groupBy(F.col("feature").alias("_f")).agg((F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("_m"))
    gap = F.col("m") - F.col("_m")
    t = tall.join(total, F.col("feature") == F.col("_f")).groupBy("feature").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * gap * gap).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    return t.select("feature", F.try_divide(
        F.col("between") / (F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))).alias("score"))


def regression_scores(df: DataFrame, cols: Sequence[str], label: str = "target") -> DataFrame:
    """``r^2 / (1 - r^2) * (n - 2)`` per feature."""
    from opspark.operators.profile import long_form

    y = as_number(df, label)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.corr(as_number(df, c), y).alias(f"r{i}"),
                 F.count(F.when(y.isNotNull(), as_number(df, c))).cast("double").alias(f"n{i}")]
    tall = long_form(df.agg(*aggs), cols, {"r": "r", "n": "n"}, "feature")
    r2 = F.col("r") * F.col("r")
    return tall.select("feature", F.try_divide(r2 * (F.col("n") - 2), 1 - r2).alias("score"))


def mutual_information(
    df: DataFrame, cols: Sequence[str], label: str = "target", bins: int = 10, regression: bool = False
) -> DataFrame:
    """Mutual information (nats) of each feature, cut at quantiles, with the label.

    A binned estimate: features, and the label of a regression, fall in at most
    ``bins`` quantile bins; the contingency counts are small per feature.
    """
    wanted = list(cols) + ([label] if regression else [])
    probs = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(df, {c: as_number(df, c) for c in wanted}, probs)

    def cut(c):
        v = as_number(df, c)
        inner = sorted({e for e in edges[c] if e is not None})
        level = sum([F.when(v > F.lit(e), 1).otherwise(0) for e in inner], F.lit(0))
        return F.when(v.isNotNull(), level)

    y = (cut(label) if regression else F.col(label)).cast("string")
    items = [F.struct(F.lit(c).alias("feature"), cut(c).alias("x"), y.alias("y")) for c in cols]
    tall = df.select(F.explode(F.array(*items)).alias("r")).select("r.*").where("x is not null and y is not null")
    cells = tall.groupBy("feature", "x", "y").agg(F.count("*").cast("double").alias("c"))
    by_x = cells.groupBy("feature", "x").agg(F.sum("c").alias("cx"))
    by_y = cells.groupBy("feature", "y").agg(F.sum("c").alias("cy"))
    total = cells.groupBy("feature").agg(F.sum("c").alias("n"))
    whole = cells.join(by_x, ["feature", "x"]).join(by_y, ["feature", "y"]).join(total, "feature")
    part = F.col("c") / F.col("n") * F.ln(F.col("c") * F.col("n") / (F.col("cx") * F.col("cy")))
    return whole.groupBy("feature").agg(F.sum(part).alias("score"))


def top_features(scores: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best features, ties by name."""
    return scores.orderBy(F.col("score").desc_nulls_last(), "feature").limit(k)


def score_features(df: DataFrame, cols: Sequence[str], method: str, label: str = "target") -> DataFrame:
    """Scores of the chosen selection method; chi-square needs non-negative features."""
    regression = is_regression(df, label)
    if method == "mutual_info":
        return mutual_information(df, cols, label, regression=regression)
    if method == "chi2":
        low = df.agg(*[F.min(as_number(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        if all(v is None or v >= 0 for v in low):
            return chi_square_scores(df, cols, label)
        return anova_scores(df, cols, label)
    if method == "anova":
        return regression_scores(df, cols, label) if regression else anova_scores(df, cols, label)
    raise ValueError(f"unknown selection method: {method}")


def recursive_elimination(
    df: DataFrame, cols: Sequence[str], label: str = "target", keep: int = 20, trees: int = 50, seed: int = 42
) -> list[tuple[str, float]]:
    """Drop the least important feature of a forest until ``keep`` are left."""
    from opspark.operators.models import fit_forest

    left = list(cols)
    while True:
        model = fit_forest(df, left, label, trees=trees, seed=seed, max_depth=5)
        weights = list(model.stages[-1].featureImportances.toArray())
        if len(left) <= keep:
            return list(zip(left, [float(w) for w in weights]))
        worst = min(range(len(left)), key=lambda i: (weights[i], -i))
        left.pop(worst)


def fit_selection(
    df: DataFrame, method: str = "mutual_info", k: int = 20, variance_threshold: float = 0.01, label: str = "target"
) -> list[str]:
    """Variance filter, then the ``k`` best features by the chosen method. Sparse columns are not scored and stay."""
    cols = [c for c in df.columns if c != label]
    if method == "none" or label not in df.columns:
        return cols
    sparse = [c for c in cols if isinstance(df.schema[c].dataType, T.StructType)]
    cols = [c for c in cols if c not in sparse]
    if variance_threshold > 0:
        cols = keep_varying(df, cols, variance_threshold)
    if method == "recursive":
        return [c for c, _ in recursive_elimination(df, cols, label, min(k, len(cols)))] + sparse
    best = top_features(score_features(df, cols, method, label), min(k, len(cols)))
    return [r["feature"] for r in best.collect()] + sparse


def project(df: DataFrame, features: Sequence[str], label: str = "target") -> DataFrame:
    """The stored feature list, and the label where there is one."""
    tail = [label] if label in df.columns else []
    return df.select(*[F.col(f"`{c}`") for c in features], *tail)
