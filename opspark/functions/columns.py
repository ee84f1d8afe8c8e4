"""Column expressions: missing values, bins, z-scores, keyed pseudo-randomness."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATS = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns of a numeric type; booleans are not numeric."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Categorical columns, that is the string ones."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def id_columns(df: DataFrame) -> list[str]:
    """Columns whose name contains ``id`` in any case."""
    return [c for c in df.columns if "id" in c.lower()]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FLOATS):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double with NaN turned into null."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, FLOATS):
        col = F.when(~F.isnan(col), col)
    return col.cast("double")


def is_finite(col: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) < F.lit(float("inf"))), F.lit(False))


def z_score(col: Column, mean, std) -> Column:
    """Absolute z-score; null when the deviation is zero."""
    return F.abs(F.try_divide(col - mean, F.lit(std) if not isinstance(std, Column) else std))


def bin_index(col: Column, low, high, bins: int = 10) -> Column:
    """Equal-width bin 0..bins-1 with the last bin closed; null outside the range.

    A range of no width is widened by one half to either side.
    """
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    flat = low == high
    lo = F.when(flat, low - 0.5).otherwise(low)
    hi = F.when(flat, high + 0.5).otherwise(high)
    raw = F.floor((col - lo) / ((hi - lo) / F.lit(float(bins))))
    return F.when(col.between(lo, hi), F.least(raw, F.lit(bins - 1)).cast("int"))


def key_digest(key: Column, seed: int | str) -> Column:
    """MD5 hex text of ``key-seed``: the order used for reproducible draws."""
    return F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))).cast("binary"))


def digest_number(digest: Column, digits: int = 7) -> Column:
    """The first hex digits of a digest as a BIGINT."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def keyed_uniform(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) fixed by the key and the seed."""
    return digest_number(key_digest(key, seed)) / F.lit(float(16**7))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division giving null for a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
