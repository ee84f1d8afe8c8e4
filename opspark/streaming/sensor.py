"""Window features of sensor readings; the same builders serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opspark.session import bounded_broadcast, cut_lineage, fits

#: Ways in which a stream spreads the readings of one (sensor, window) pair over tasks.
SALTS = 8

#: Readings of a window that a batch leaves to one task.
PART_ROWS = 1_000_000


def event_time(df: DataFrame, ms: str = "timestamp", delay: str = "5 seconds") -> DataFrame:
    """Event time from epoch milliseconds, with a watermark on streams."""
    timed = df.withColumn("event_time", F.timestamp_millis(F.col(ms)))
    return timed.withWatermark("event_time", delay) if df.isStreaming else timed


def window_means(df: DataFrame, key: str = "sensor_id", ts: str = "event_time", value: str = "value",
                 width: str = "1 minute") -> DataFrame:
    """Mean per key and tumbling window, labelled with the window end."""
    out = df.groupBy(F.window(ts, width).alias("w"), key).agg(F.avg(value).alias("avg_value"))
    return out.select(key, "avg_value", F.col("w.end").alias("ts"))


def window_features(df: DataFrame, key: str = "sensor_id", ts: str = "event_time", value: str = "value",
                    width: str = "1 minute", deviations: float = 2.5, salts: int = SALTS) -> DataFrame:
    """Mean, extremes, population deviation, count and anomalies per key and window.

    Anomalies lie more than ``deviations`` deviations from the window mean, so they
    need the finished statistics, which are sums with map-side partials; then the readings meet them, and hits are counted with partials
    again. No task ever holds the values of a window.

    On a batch the statistics are written down: where they are counted to be small they go to all tasks and the readings stay where they
    are; otherwise both are shuffled, and a window is spread over as many tasks as its counted readings need. A stream in append mode
    copies them to ``salts`` parts. ``count`` is the number of readings with a value; rows
    with a null key form windows of their own.
    """
    cut = df.select(F.window(ts, width).alias("w"), F.col(key), F.col(value).cast("double").alias("_v"), F.col(ts).alias("_t"))
    stats = cut.groupBy("w", key).agg(
        F.avg("_v").alias("_a"), F.min("_v").alias("_l"), F.max("_v").alias("_h"), F.stddev_pop("_v").alias("_s"),
        F.count("_v").alias("_n"))
    names = {"w": "_w", key: "_key", "_salt": "_part"}
    if df.isStreaming:
        parts = stats.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        lines = cut.select("w", key, "_v", F.pmod(F.xxhash64("_v", "_t"), F.lit(salts)).cast("int").alias("_salt"))
        both = _meet(lines, parts.withColumnsRenamed(names), key)
        far = F.abs(F.col("_v") - F.col("_a")) > F.lit(deviations) * F.col("_s")
        out = both.groupBy("w", key, "_a", "_l", "_h", "_s", "_n").agg(F.count_if(far).alias("_k"))
    else:
        stats = cut_lineage(stats)
        small = fits(stats)
        if small:
            both = _meet(cut.select("w", key, "_v", F.lit(0).alias("_salt")), F.broadcast(stats.withColumn("_salt", F.lit(0)).withColumnsRenamed(names)), key)
        else:
            many = F.ceil(F.col("_n") / PART_ROWS).cast("int")
            hot = stats.where(F.col("_n") > PART_ROWS).select(F.col("w").alias("_hw"), F.col(key).alias("_hk"), many.alias("_many"))
            lines = cut.join(bounded_broadcast(hot), (F.col("w") == F.col("_hw")) & F.col(key).eqNullSafe(F.col("_hk")), "left").select(
                "w", key, "_v", F.pmod(F.xxhash64("_v", "_t"), F.coalesce("_many", F.lit(1))).cast("int").alias("_salt"))
            parts = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(many, F.lit(1)) - 1)))
            both = _meet(lines, parts.withColumnsRenamed(names), key)
        far = F.abs(F.col("_v") - F.col("_a")) > F.lit(deviations) * F.col("_s")
        # only windows with hits come back, so that the statistics are not a key of the count
        hits = both.where(far).groupBy("w", key).agg(F.count("*").alias("_k")).withColumnsRenamed({"w": "_w", key: "_key"})
        met = stats.join(F.broadcast(hits) if small else hits, (F.col("w") == F.col("_w")) & F.col(key).eqNullSafe(F.col("_key")), "left")
        out = met.withColumn("_k", F.coalesce("_k", F.lit(0)))
    return out.select(
        F.col(key), F.unix_millis(F.col("w.start")).alias("window_start"), F.unix_millis(F.col("w.end")).alias("window_end"),
        F.date_format("w.end", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
        _rounded(F.col("_a"), 2).alias("avg_value"), F.round("_l", 2).alias("min_value"), F.round("_h", 2).alias("max_value"),
        _rounded(F.col("_s"), 2).alias("std_dev"), F.col("_n").alias("count"), F.col("_k").alias("anomaly_count"),
        _rounded(F.col("_k") / F.col("_n"), 3).alias("anomaly_rate"))


def _meet(lines: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Readings with the statistics of their window; a null key is a key."""
    return lines.join(parts, (F.col("w") == F.col("_w")) & F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_part")))


def _rounded(value: Column, places: int) -> Column:
    """Rounded half up after the last bits are dropped, which depend on the order of a sum."""
    return F.round(F.round(value, 9), places)


FEATURE_FIELDS = ["avg_value", "min_value", "max_value", "std_dev", "count", "anomaly_count", "anomaly_rate"]


def nested(features: DataFrame, key: str = "sensor_id") -> DataFrame:
    """The message form: features packed in one struct."""
    return features.select(
        F.col(key).alias("sensor_id"), "window_start", "window_end", "event_time",
        F.struct(*FEATURE_FIELDS).alias("features"))
