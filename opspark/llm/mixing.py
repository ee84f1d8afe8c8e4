"""Mixing sources to target weights along a time-varying curriculum (DataFrame operations only).

Training time runs from 0 to 1. Every source has a weight schedule, a straight line from ``start`` to ``end`` times its
weight with mean 1, so that its integral over all time is its weight, and its integral up to a time is the part of its
target that training has asked for by then. A source's documents lie one after another, in the order of a digest, along
the words that the source delivers; where they are used up they begin again. The position of a document is the time at
which the demand reaches the middle of its words: the integral, inverted. Documents sorted by position are the
training order.

Targets come from the weights by pouring: a source takes no more than ``repeats`` times its size, and what it cannot take
goes to the others by weight. With sources in the order of ``limit / weight`` this has a closed form over running sums
of one row per source.

Running sums over a source are two-level: sums inside digest ranges, then over the ranges of the source, so that a
source holding a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opspark.llm.common import digits, table, word_count
from opspark.session import cut_lineage

#: Rows that one task orders, about.
RANGE_ROWS = 200_000

#: Weights by place in the order of sources, and the factors of the weight at time 0 and 1 (mean 1).
WEIGHTS = (3, 1, 2)
RAMPS = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))

#: Words of the mix in percent of all words, and how often a document may come.
SHARE_PERCENT = 150
REPEATS = 2

#: Digits of the digest that orders a source's documents.
_SPAN = 1 << 48


def source_targets(sizes: DataFrame, weights=WEIGHTS, ramps=RAMPS, share_percent=SHARE_PERCENT, repeats=REPEATS) -> DataFrame:
    """(source, source_size, weight, ramp_from, ramp_to, target) from (source, source_size), one row per source.

    Sources go by code point, null last. An empty source has target 0.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    pick = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col("place") % len(values) + 1).cast("int"))
    named = (
        sizes.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", pick(weights))
        .withColumn("ramp_from", pick([float(a) for a, _ in ramps])).withColumn("ramp_to", pick([float(b) for _, b in ramps]))
        .withColumn("limit", F.col("source_size") * repeats)
    )
    # sources that fill up come first: a source is full when a fair share of what is left is above its limit
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = (
        named.withColumn("left_words", F.sum("source_size").over(whole) * (share_percent / 100) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", F.col("limit") * F.col("left_weight") <= F.col("left_words") * F.col("weight"))
    )
    # all sources after the last full one share what that one left
    level = F.first(F.when(~F.col("full"), F.struct("left_words", "left_weight")), True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        left.withColumn("level", level)
        .withColumn("target", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("level.left_words") / F.col("level.left_weight")))
        .select("source", "source_size", "weight", "ramp_from", "ramp_to", "target")
    )


def position(words: Column, target: Column, ramp_from: Column, ramp_to: Column) -> Column:
    """The time by which a source has been asked for so many of its target's words.

    The integral of the line is t * from + t^2 * (to - from) / 2, equal to words / target at the time sought.
    """
    part, slope = words / target, ramp_to - ramp_from
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(
        F.abs(slope) < 1e-9, part / ramp_from
    ).otherwise((F.sqrt(F.greatest(F.lit(0.0), ramp_from * ramp_from + 2 * slope * part)) - ramp_from) / slope)))


def mix(df: DataFrame, key: list[str], source: str = "source", size: str = "size", **options) -> DataFrame:
    """The rows of ``df`` in a column ``row`` with ``source_size``, ``target``, ``taken`` and ``takes``.

    ``takes`` lists a row's uses in the mix as (words, position); it is empty for a row that is not used. The last row of a
    source is used in part, so a source delivers its target to the word, as far as its size times ``repeats`` goes. A row
    of size 0 is never used. ``key`` names the columns whose digest orders the rows of a source; equal rows stand in
    any order, and as they are equal the result is the same. Null is a source of its own. Columns stay inside ``row``,
    so no name can clash.
    """
    repeats = options.get("repeats", REPEATS)
    rows = df.select(
        F.struct(*(df[c] for c in df.columns)).alias("row"), df[source].alias("source"), df[size].cast("long").alias("size"),
        digits(*(df[c] for c in key)).alias("digest"))
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sizes = cut_lineage(by_source)
    ranges = max(256, int((sizes.agg(F.max("rows")).first()[0] or 0) // RANGE_ROWS))
    rows = rows.withColumn("range", F.floor(F.col("digest") / (_SPAN // ranges)))
    ends = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ends = ends.withColumn("ahead", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    targets = source_targets(sizes.select("source", "source_size"), **options)
    ends = ends.alias("e").join(targets.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source"))).select(
        F.col("e.source").alias("end_source"), F.col("e.range").alias("end_range"), "ahead", "source_size", "target", "ramp_from", "ramp_to")
    inside = Window.partitionBy("source", "range").orderBy("digest", *(F.col("row")[c] for c in key))
    placed = rows.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).join(
        ends, F.col("source").eqNullSafe(F.col("end_source")) & (F.col("range") == F.col("end_range"))
    ).withColumn("begin", F.col("ahead") + F.col("inside"))
    goal = F.round("target").cast("long")
    uses = F.array(*(
        F.struct(
            F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - F.col("begin") - turn * F.col("source_size"))).alias("words"),
            (F.col("begin") + turn * F.col("source_size")).alias("from"))
        for turn in range(repeats)))
    takes = F.transform(F.filter(uses, lambda u: u["words"] > 0), lambda u: F.struct(
        u["words"].alias("words"), position(u["from"] + u["words"] / 2, F.col("target"), F.col("ramp_from"), F.col("ramp_to")).alias("position")))
    return placed.withColumn("takes", takes).select(
        "row", "source_size", "target", F.aggregate("takes", F.lit(0).cast("long"), lambda a, u: a + u["words"]).alias("taken"), "takes")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per use, with ``words`` and ``position``, range-sorted by position."""
    return (
        mixed.select("*", F.explode("takes").alias("take"))
        .select("row", "source_size", "target", "take.words", "take.position")
        .repartitionByRange("position").sortWithinPartitions("position")
    )


def op6_curriculum(spark, folder: str) -> DataFrame:
    """What the mix takes of each document, in training order (by first use; unused documents last)."""
    docs = table(spark, folder, "documents")
    narrow = cut_lineage(docs.select("doc_id", "source", word_count(docs["text"]).alias("size")))
    mixed = mix(narrow, ["doc_id", "size"])
    return (
        mixed.select("row.doc_id", "row.size", "source_size", "target", "taken", F.try_element_at("takes", F.lit(1))["position"].alias("first_position"))
        .repartitionByRange(F.col("first_position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("first_position").asc_nulls_last())
    )


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM d GROUP BY source
), n AS (
  SELECT *, [3, 1, 2][place % 3 + 1] AS weight, [1.5, 0.5, 1.0][place % 3 + 1]::DOUBLE AS ramp_from, [0.5, 1.5, 1.0][place % 3 + 1]::DOUBLE AS ramp_to,
         source_size * 2 AS cap FROM s
), l AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE AS left_words,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM n WINDOW before AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, cap::DOUBLE * left_weight::DOUBLE <= left_words * weight AS is_full FROM l
), v AS (
  SELECT left_words AS lw, left_weight::DOUBLE AS lg FROM f WHERE NOT is_full ORDER BY cap::DOUBLE / weight, place LIMIT 1
), t AS (
  SELECT source, source_size, ramp_from, ramp_to, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * (SELECT lw FROM v) / (SELECT lg FROM v) END AS target FROM f
), o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, ramp_from, ramp_to, round(target)::BIGINT AS goal,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '\N') || '|' || d.size), 1, 12))::BIGINT, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), u AS (
  SELECT *, greatest(0, least(size, goal - start)) AS w1, greatest(0, least(size, goal - start - source_size)) AS w2 FROM o
), p AS (
  SELECT *, ((start + w1 / 2.0::DOUBLE) / target) AS part, ramp_to - ramp_from AS slope FROM u
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (w1 + w2)::BIGINT AS taken,
       CASE WHEN w1 > 0 THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN abs(slope) < 1e-9 THEN part / ramp_from
            ELSE (sqrt(greatest(0.0::DOUBLE, ramp_from * ramp_from + 2 * slope * part)) - ramp_from) / slope END)) END AS first_position
FROM p
"""
