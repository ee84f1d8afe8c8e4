"""Validating and profiling a table: every check is one wide aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from opspark.functions.columns import as_number, id_columns, is_missing, numeric_columns, z_score
from opspark.operators.quantiles import exact_quantiles
from opspark.operators.ranking import running_totals

# The type families of the schema check.
TYPE_FAMILIES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType),
    "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def long_form(row: DataFrame, columns: Sequence[str], prefix: dict[str, str], name: str = "column") -> DataFrame:
    """Turn a one-row wide aggregate into one row per column.

    ``prefix`` maps an output name to the alias prefix used in the aggregate.
    """
    items = [
        F.struct(F.lit(c).alias(name), *[F.col(f"{p}{i}").alias(o) for o, p in prefix.items()])
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """Number of records and of features."""
    return df.agg(F.count("*").alias("total_records")).withColumn(
        "total_features", F.lit(len(df.columns)).cast("bigint"))


def data_types(df: DataFrame) -> DataFrame:
    """Column names with their Spark type names."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column string, data_type string")


def missing_ratio(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of missing values for each column holding any, with a threshold flag."""
    cols = df.columns
    row = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)])
    return (
        long_form(row, cols, {"missing_ratio": "m"})
        .where(F.col("missing_ratio") > 0)
        .withColumn("over_threshold", F.col("missing_ratio") > threshold)
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every group of equal rows; nulls count as equal."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each repeated row once with the number of extra copies.

    Counting before the shuffle keeps a huge group of copies to one row per
    task; ``explode_copies`` gives the copies themselves.
    """
    groups = df.groupBy(*df.columns).agg((F.count("*") - 1).alias("extra_copies"))
    return groups.where(F.col("extra_copies") > 0)


def explode_copies(counted: DataFrame, block: int = 1_000_000) -> DataFrame:
    """Repeat each row ``extra_copies`` times, cut in blocks so that tasks share the work."""
    blocks = counted.withColumn("_b", F.explode(F.sequence(F.lit(0), F.floor((F.col("extra_copies") - 1) / block))))
    spread = blocks.repartition(*[F.col(c) for c in counted.columns], F.col("_b"))
    size = F.least(F.lit(block).cast("bigint"), F.col("extra_copies") - F.col("_b") * block)
    copies = spread.withColumn("_c", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
    return copies.drop("extra_copies", "_b", "_c")


def iqr_bounds(df: DataFrame, cols: Sequence[str], threshold: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper fences per column from exact quartiles."""
    quart = exact_quantiles(df, {c: as_number(df, c) for c in cols}, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = quart[c]
        if q1 is not None:
            out[c] = (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
    return out


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None, float | None]]:
    """Mean, sample deviation and population deviation per column in one scan."""
    aggs = []
    for i, c in enumerate(cols):
        v = as_number(df, c)
        aggs += [F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"), F.stddev_pop(v).alias(f"p{i}")]
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    return {c: (row[f"a{i}"], row[f"s{i}"], row[f"p{i}"]) for i, c in enumerate(cols)}


def outlier_flag(df: DataFrame, col: str, method: str, bounds, threshold: float) -> Column:
    """True for an outlier, null or false otherwise."""
    v = as_number(df, col)
    if method == "iqr":
        low, high = bounds
        return (v < F.lit(low)) | (v > F.lit(high))
    mean, std, _ = bounds
    return z_score(v, F.lit(mean), F.lit(std)) > F.lit(threshold)


def outlier_counts(df: DataFrame, method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """Outliers per numeric column, columns without any left out."""
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method: {method}")
    cols = numeric_columns(df)
    fitted = iqr_bounds(df, cols, threshold) if method == "iqr" else moments(df, cols)
    cols = [c for c in cols if c in fitted]
    row = df.agg(*[
        F.count_if(outlier_flag(df, c, method, fitted[c], threshold)).alias(f"o{i}") for i, c in enumerate(cols)])
    return long_form(row, cols, {"outliers": "o"}).where(F.col("outliers") > 0)


def unique_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column.

    The exact form counts distinct (column, value) pairs, so every column shares
    one shuffle with map-side removal of repeats.
    """
    cols = df.columns
    if approximate:
        row = df.agg(*[F.approx_count_distinct(F.when(~is_missing(df, c), F.col(f"`{c}`"))).alias(f"u{i}")
                       for i, c in enumerate(cols)])
        return long_form(row, cols, {"unique_count": "u"})
    seen = _values(df, cols).distinct()
    counts = seen.groupBy("i").agg(F.count("*").alias("unique_count"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, column string")
    # one row per column of the schema
    joined = F.broadcast(names).join(counts, "i", "left")
    return joined.select("column", F.coalesce("unique_count", F.lit(0)).alias("unique_count"))


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-missing values of many columns as ``(i, whole, number, text)``, each in the field of its type."""
    items = []
    for i, c in enumerate(cols):
        kind = df.schema[c].dataType
        col = F.when(~is_missing(df, c), F.col(f"`{c}`"))
        whole, number, text = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            whole = col.cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            number = col.cast("double")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(col)
        else:
            text = col.cast("string")
        items.append(F.struct(F.lit(i).alias("i"), whole.alias("whole"), number.alias("number"), text.alias("text")))
    tall = df.select(F.explode(F.array(*items)).alias("p")).select("p.*")
    return tall.where(F.coalesce(F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull(), F.lit(False)))


def _copies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(i, whole, number, text, c)``: occurrences of every non-missing value."""
    return _values(df, cols).groupBy("i", "whole", "number", "text").agg(F.count("*").alias("c"))


def schema_errors(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Missing columns and columns of another type family."""
    errors = []
    absent = sorted(set(expected) - set(df.columns))
    if absent:
        errors.append(f"Missing columns: {absent}")
    for name, family in expected.items():
        if name in df.columns:
            kind = df.schema[name].dataType
            ok = isinstance(kind, TYPE_FAMILIES[family]) if family in TYPE_FAMILIES else kind.simpleString() == family
            if not ok:
                errors.append(f"Column '{name}' has type '{kind.simpleString()}', expected '{family}'")
    return errors


#: What a value is tried to be cast to, by expected family; other families name a type.
CAST_OF = {"int": "bigint", "float": "double", "bool": "boolean", "datetime": "timestamp"}


def schema_check(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """One row per expected column: ``column, expected, error, rows, nulls, rejected``.

    ``error`` is ``missing``, ``type`` for another type family, or null. Rows, nulls and the values that can't be
    cast to the expected family are counted in one scan; the last two are null for a missing column.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def fits(name: str, family: str) -> bool:
        return isinstance(kinds[name], TYPE_FAMILIES[family]) if family in TYPE_FAMILIES else kinds[name].simpleString() == family

    aggs, items = [F.count("*").alias("rows")], []
    for i, (name, family) in enumerate(expected.items()):
        error = None if name in kinds and fits(name, family) else "type" if name in kinds else "missing"
        nulls = rejected = F.lit(None).cast("bigint")
        if name in kinds:
            v = F.col(f"`{name}`")
            aggs += [F.count_if(v.isNull()).alias(f"n{i}"), F.count_if(v.isNotNull() & v.try_cast(CAST_OF.get(family, family)).isNull()).alias(f"r{i}")]
            nulls, rejected = F.col(f"n{i}"), F.col(f"r{i}")
        items.append(F.struct(F.lit(name).alias("column"), F.lit(family).alias("expected"), F.lit(error).cast("string").alias("error"),
                              F.col("rows"), nulls.alias("nulls"), rejected.alias("rejected")))
    return df.agg(*aggs).select(F.explode(F.array(*items)).alias("r")).select("r.*")


def expectations(df: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Not-null on every column and unique on the id columns, one row each.

    Values of an id column that occur more than once all count as unexpected.
    """
    ids = id_columns(df) if ids is None else list(ids)
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    nulls = long_form(row, df.columns, {"unexpected": "n"}).select(
        "column", F.lit("not_null").alias("expectation"), "unexpected")
    parts = [nulls]
    if ids:
        found = _copies(df, ids).groupBy("i").agg(
            F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("unexpected"))
        names = df.sparkSession.createDataFrame(list(enumerate(ids)), "i int, column string")
        found = F.broadcast(names).join(found, "i", "left")
        parts.append(found.select(
            "column", F.lit("unique").alias("expectation"),
            F.coalesce("unexpected", F.lit(0)).cast("bigint").alias("unexpected")))
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("success", F.col("unexpected") == 0)


def validation_errors(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The two checks that fail a table: too many missing values, repeated rows."""
    missing = missing_ratio(df, threshold).where("over_threshold").select(
        "column", F.lit("missing_values").alias("error"), F.col("missing_ratio").alias("amount"))
    repeated = duplicate_count(df).where(F.col("duplicate_count") > 0).select(
        F.lit(None).cast("string").alias("column"), F.lit("duplicate_records").alias("error"),
        F.col("duplicate_count").cast("double").alias("amount"))
    return missing.unionByName(repeated)


def verdict(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Passed exactly when there are no validation errors."""
    return validation_errors(df, threshold).agg(
        F.count("*").alias("error_count"), (F.count("*") == 0).alias("validation_passed"))


def validate(df: DataFrame) -> dict[str, DataFrame]:
    """Every part of the validation report as a lazy DataFrame."""
    return {
        "shape": shape(df), "data_types": data_types(df), "missing_values": missing_ratio(df),
        "duplicates": duplicate_count(df), "outliers": outlier_counts(df),
        "unique_counts": unique_counts(df), "verdict": verdict(df),
    }


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column."""
    cols = list(cols or numeric_columns(df))
    quart = exact_quantiles(df, {c: as_number(df, c) for c in cols}, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        v = as_number(df, c)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    row = df.agg(*aggs)
    for i, c in enumerate(cols):
        for j, q in enumerate(quart[c]):
            row = row.withColumn(f"q{j + 1}_{i}", F.lit(q).cast("double"))
    return long_form(row, cols, {"n": "n", "mean": "a", "std": "s", "low": "l", "high": "h",
                                 "q25": "q1_", "q50": "q2_", "q75": "q3_"})


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every column pair from one scan."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(as_number(df, a), as_number(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = [F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r{i}").alias("pearson"))
             for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman correlation: Pearson of average ranks, over rows complete in ``cols``.

    Ranks come from distinct values with their counts, and rows are counted per
    distinct tuple first, so hot values meet the rank tables only once.
    """
    whole = df.select(*[as_number(df, c).alias(c) for c in cols]).na.drop("any")
    tuples = whole.groupBy(*cols).agg(F.count("*").alias("_w"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("v"), F.col("_w")) for c in cols]
    tall = tuples.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    counts = tall.groupBy("column", "v").agg(F.sum("_w").alias("c"))
    ranks = running_totals(counts, ["column"], "v", ["c"], few=len(cols)).select(
        "column", "v", (F.col("cum_c") - (F.col("c") - 1) / 2).alias("rank"))
    ranked = tuples
    for c in cols:
        one = ranks.where(F.col("column") == c).select(F.col("v").alias(c), F.col("rank").alias(f"_r_{c}"))
        ranked = ranked.join(one, c)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    w = F.col("_w").cast("double")
    aggs = [F.sum(w).alias("n")]
    for c in cols:
        r = F.col(f"_r_{c}")
        aggs += [F.sum(w * r).alias(f"s_{c}"), F.sum(w * r * r).alias(f"q_{c}")]
    for a, b in pairs:
        aggs.append(F.sum(w * F.col(f"_r_{a}") * F.col(f"_r_{b}")).alias(f"x_{a}_{b}"))
    row = ranked.agg(*aggs)
    n = F.col("n")

    def cov(sum_xy, sx, sy):
        return sum_xy / n - (sx / n) * (sy / n)

    items = []
    for a, b in pairs:
        top = cov(F.col(f"x_{a}_{b}"), F.col(f"s_{a}"), F.col(f"s_{b}"))
        spread = cov(F.col(f"q_{a}"), F.col(f"s_{a}"), F.col(f"s_{a}")) * cov(
            F.col(f"q_{b}"), F.col(f"s_{b}"), F.col(f"s_{b}"))
        items.append(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"),
                              F.try_divide(top, F.sqrt(spread)).alias("spearman")))
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between the extremes, empty bins included."""
    from opspark.functions.columns import bin_index

    v = as_number(df, col)
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, rows bigint")
    counts = df.select(bin_index(v, ends["lo"], ends["hi"], bins).alias("bin")).where("bin is not null")
    counts = counts.groupBy("bin").agg(F.count("*").alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return F.broadcast(every).join(counts, "bin", "left").select("bin", F.coalesce("rows", F.lit(0)).alias("rows"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(col).agg(F.count("*").alias("rows"))


def head_rows(df: DataFrame, order: str, n: int = 20, last: bool = False) -> DataFrame:
    """First or last ``n`` rows in key order, without a full sort."""
    return df.orderBy(F.col(order).desc() if last else F.col(order).asc()).limit(n)


def quality_issues(
    df: DataFrame, ids: Sequence[str] | None = None, missing_limit: float = 0.1, z_limit: float = 5.0
) -> DataFrame:
    """Issues of the monitoring check: missing share, extreme values, repeated ids."""
    ids = id_columns(df) if ids is None else list(ids)
    nums = numeric_columns(df)
    fitted = moments(df, nums)
    nums = [c for c in nums if fitted[c][1]]
    cols = df.columns
    aggs = [F.avg(is_missing(df, c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]
    aggs += [F.count_if(z_score(as_number(df, c), F.lit(fitted[c][0]), F.lit(fitted[c][1])) > z_limit).alias(f"x{i}")
             for i, c in enumerate(nums)]
    row = df.agg(*aggs)
    items = [F.struct(F.lit("high_missing_values").alias("type"), F.lit(c).alias("column"),
                      F.col(f"m{i}").alias("amount"), (F.col(f"m{i}") > missing_limit).alias("bad"))
             for i, c in enumerate(cols)]
    items += [F.struct(F.lit("extreme_values").alias("type"), F.lit(c).alias("column"),
                       F.col(f"x{i}").cast("double").alias("amount"), (F.col(f"x{i}") > 0).alias("bad"))
              for i, c in enumerate(nums)]
    found = row.select(F.explode(F.array(*items)).alias("r")).select("r.*").where("bad").drop("bad")
    if not ids:
        return found
    # missing ids repeat each other too
    gaps = df.agg(*[F.count_if(is_missing(df, c)).alias(f"g{i}") for i, c in enumerate(ids)])
    extra = long_form(gaps, ids, {"g": "g"}).select("column", F.greatest(F.col("g") - 1, F.lit(0)).alias("n"))
    named = F.element_at(F.array(*map(F.lit, ids)), F.col("i") + 1)
    repeats = _copies(df, ids).groupBy("i").agg(F.sum(F.col("c") - 1).alias("n")).select(named.alias("column"), "n")
    repeats = repeats.unionByName(extra).groupBy("column").agg(F.sum("n").cast("double").alias("amount"))
    repeats = repeats.where(F.col("amount") > 0).select(F.lit("duplicate_ids").alias("type"), "column", "amount")
    return found.unionByName(repeats)


def quality_score(df: DataFrame, ids: Sequence[str] | None = None, alert_below: float = 0.8) -> DataFrame:
    """One tenth off per issue, never below zero, with the alert flag."""
    score = F.greatest(F.lit(0.0), F.lit(1.0) - F.count("*") * F.lit(0.1))
    return quality_issues(df, ids).agg(F.count("*").alias("issues"), score.alias("quality_score")).withColumn(
        "alert", F.col("quality_score") < alert_below)
