"""Feature tables: latest values, online lookup, point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StructType

from opspark.operators.scans import CELL_ROWS, largest_group, with_heads
from opspark.session import bounded_broadcast


@dataclass(frozen=True)
class FeatureView:
    """A declared set of features: keys, event-time column, time to live, schema."""

    name: str
    keys: tuple[str, ...]
    event_time: str
    ttl: timedelta
    schema: StructType | None = None
    features: tuple[str, ...] = field(default=())


def seconds(col: Column) -> Column:
    """Event time as exact seconds with the fraction."""
    return F.unix_micros(col.cast("timestamp")) / F.lit(1_000_000.0)


def latest(df: DataFrame, keys: Sequence[str], event_time: str, values: Sequence[str],
           after: datetime | None = None, until: datetime | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest row per key in the interval (after, until]; partial maxima before the shuffle, no sort."""
    kind = df.schema[event_time].dataType
    if after is not None:
        df = df.where(F.col(event_time) > F.lit(after).cast(kind))
    if until is not None:
        df = df.where(F.col(event_time) <= F.lit(until).cast(kind))
    row = F.struct(*[F.col(v) for v in values])
    best = F.max_by(F.struct(F.col(event_time), row.alias("row")),
                    F.struct(F.col(event_time), *[F.col(t) for t in tie_break]))
    return df.groupBy(*keys).agg(best.alias("b")).select(*keys, f"b.{event_time}", "b.row.*")


def merge_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """Newest-wins merge of two tables with the same columns; the new side wins ties."""
    values = [c for c in old.columns if c not in keys and c != event_time]
    both = old.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    return latest(both, keys, event_time, values, tie_break=["_rank"]).select(*old.columns)


def online_lookup(entities: DataFrame, table: DataFrame, keys: Sequence[str], features: Sequence[str],
                  event_time: str | None = None, now=None, ttl: timedelta | None = None) -> DataFrame:
    """Entity rows with their latest features; null when unknown, or older than ``ttl`` where given.

    The asked-for entities are the small side: when few (counted), the table is
    cut by a broadcast semi join and scanned without a shuffle.
    """
    asked = bounded_broadcast(entities.select(*keys).distinct())
    hits = table.join(asked, list(keys), "left_semi")
    value = {f: F.col(f"_f_{f}") for f in features}
    if ttl is not None:
        moment = now if isinstance(now, Column) else F.lit(now)
        fresh = (seconds(moment) - seconds(F.col("_ts"))) <= F.lit(ttl.total_seconds())
        value = {f: F.when(fresh, c) for f, c in value.items()}
    named = [F.col(k).alias(f"_k_{k}") for k in keys] + [F.col(f).alias(f"_f_{f}") for f in features]
    if event_time:
        named.append(F.col(event_time).alias("_ts"))
    found = hits.select(*named)
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    return entities.join(found, on, "left").select(
        *[F.col(c) for c in entities.columns], *[value[f].alias(f) for f in features])


def point_in_time(spine: DataFrame, history: DataFrame, keys: Sequence[str], spine_time: str, event_time: str,
                  features: Sequence[str], ttl: timedelta, tie_break: str | None = None, slices: int = 4,
                  cell_rows: int = CELL_ROWS) -> DataFrame:
    """For every spine row the newest feature row not later than it and not older than ``ttl``.

    Time is cut in slices of ``ttl / slices``. A feature row can only matter in
    its own slice or the next ``slices`` ones, so the newest row per key and slice is
    handed on, and a carry-forward window runs per (key, slice): one shuffle
    of the rows, no range join, and a hot key spreads over its slices. Where a slice of a key is counted to
    have more than ``cell_rows`` rows, keys are scanned in cells of equal size instead.
    """
    width = ttl.total_seconds() / slices
    def cut(ts):
        return F.floor(seconds(ts) / F.lit(width))

    tie = [F.col(tie_break)] if tie_break else []
    names = list(features)
    hist = history.select(
        *keys, seconds(F.col(event_time)).alias("_at"), F.struct(*names).alias("_row"),
        *[t.alias("_tie") for t in tie], cut(F.col(event_time)).alias("_slice"))
    order = [F.col("_at")] + ([F.col("_tie")] if tie_break else [])
    asks = spine.select(
        *keys, seconds(F.col(spine_time)).alias("_at"), cut(F.col(spine_time)).alias("_slice"),
        F.lit(1).alias("_kind"), F.struct(*spine.columns).alias("_spine"))
    counted = hist.select(*keys, "_slice").unionByName(asks.select(*keys, "_slice"))
    if largest_group(counted, [*keys, "_slice"]) > cell_rows:
        lines = hist.drop("_slice").withColumn("_kind", F.lit(0)).unionByName(asks.drop("_slice"), allowMissingColumns=True)
        lines = lines.withColumn("_hit", F.when(F.col("_kind") == 0, F.struct(F.col("_at").alias("at"), F.col("_row").alias("row")))).drop("_row")
        # rows of the spine are told apart by their content, so that a crowd at one time is cut too
        lines = lines.withColumn("_content", F.xxhash64("_spine"))
        rows, series = with_heads(lines, keys, ["_at", "_kind", *(["_tie"] if tie_break else []), "_content"], latest=["_hit"])
        series = series.rowsBetween(W.unboundedPreceding, W.currentRow)
        seen = rows.withColumn("_hit", F.last("_hit", ignorenulls=True).over(series)).where((F.col("_kind") == 1) & (F.col("_head") == 1))
        return _live(seen, names, ttl)
    newest = hist.groupBy(*keys, "_slice").agg(
        F.max_by(F.struct(*[c for c in hist.columns if c not in keys and c != "_slice"]), F.struct(*order)).alias("b"))
    carried = newest.withColumn("_slice", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(slices)), lambda i: F.col("_slice") + i)))
    carried = carried.select(*keys, "_slice", "b.*")
    tag = F.lit(0)
    lines = hist.unionByName(carried.select(*hist.columns)).withColumn("_kind", tag).withColumn("_spine", F.lit(None).cast(
        spine.schema.simpleString()))
    both = lines.unionByName(asks, allowMissingColumns=True)
    w = W.partitionBy(*keys, "_slice").orderBy("_at", "_kind", *(["_tie"] if tie_break else []))
    w = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = F.when(F.col("_kind") == 0, F.struct(F.col("_at").alias("at"), F.col("_row").alias("row")))
    seen = both.withColumn("_hit", F.last(hit, ignorenulls=True).over(w)).where(F.col("_kind") == 1)
    return _live(seen, names, ttl)


def _live(seen: DataFrame, names: Sequence[str], ttl: timedelta) -> DataFrame:
    """Spine rows with the features they met, null where these are too old."""
    live = (F.col("_at") - F.col("_hit.at")) <= F.lit(ttl.total_seconds())
    return seen.select("_spine.*", *[F.when(live, F.col(f"_hit.row.{f}")).alias(f) for f in names])
