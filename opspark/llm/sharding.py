"""Shards from a consistent-hash ring with virtual nodes and bounded loads (DataFrame operations only).

The ring has a fixed number of points. A row stands at the point its key hashes to; every shard owns ``replicas``
virtual nodes, and a point belongs to the first virtual node clockwise from it. A shard takes the rows of its points, in ring
order, up to its capacity; the rows beyond go on clockwise and fill the room that other shards have, each virtual node
offering its part of its shard's room. With counts ``n`` per point, overflow and room are prefix sums over the ring, so
the whole placement is planned on one row per point and then joined to the rows: nothing but narrow counts is ordered
globally, and the ring has the same size whatever the input.

Exactly the rows above a shard's capacity move, which is the least that any placement under these capacities can move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opspark.llm.common import byte_size, digits, table
from opspark.session import cut_lineage

#: Points of the ring. 12 hexadecimal digits of a digest give the position; the leading ones give the point.
POINTS = 1 << 14
_SHIFT = (1 << 48) // POINTS


def _ring(spark, shards: int, replicas: int) -> DataFrame:
    """(point, shard, here) for every point: its owner, and the shard whose virtual node stands here, if any."""
    nodes = (
        spark.range(shards * replicas)
        .select(F.expr(f"id div {replicas}").cast("int").alias("shard"), F.expr(f"id % {replicas}").alias("replica"))
        .withColumn("point", F.floor(digits(F.lit("node"), F.col("shard"), F.col("replica")) / _SHIFT))
        .groupBy("point").agg(F.min("shard").alias("here"))
    )
    ahead = Window.orderBy("point").rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("point").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        spark.range(POINTS).withColumnRenamed("id", "point").join(nodes, "point", "left")
        .select("point", "here", F.coalesce(F.first("here", True).over(ahead), F.first("here", True).over(every)).alias("shard"))
    )


def _before(value: str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def placement(counts: DataFrame, shards: int, replicas: int, slack: float = 0.0) -> DataFrame:
    """The plan (point, lo, hi, shard, slot, moved): rows lo to hi-1 of a point go to a shard, from a slot on.

    ``counts`` has (point, n). Capacity is ceil((1 + slack) * rows / shards); with slack 0 the first
    ``rows % shards`` shards take one row more than the others. Works on POINTS rows, whatever the input.
    """
    whole = Window.partitionBy()
    of_shard = Window.partitionBy("shard")
    in_shard = of_shard.orderBy("point")
    ring = _ring(counts.sparkSession, shards, replicas).join(counts, "point", "left").fillna(0, ["n"])
    ring = ring.withColumn("rows", F.sum("n").over(whole))
    share = F.expr(f"rows div {shards}") + F.when(F.col("shard") < F.col("rows") % shards, 1).otherwise(0)
    ring = (
        ring.withColumn("capacity", (share if slack == 0 else F.ceil(F.col("rows") * (1 + slack) / shards)).cast("long"))
        .withColumn("slot", F.least(_before("n", in_shard), F.col("capacity")))
        .withColumn("kept", F.least(F.col("n"), F.col("capacity") - F.col("slot")))
        .withColumn("full", F.sum("kept").over(of_shard))
    )
    ring = cut_lineage(ring)
    # a virtual node's own point belongs to its shard, so the room of a shard can be dealt over its nodes here
    nodes = (
        ring.where("here is not null")
        .withColumn("k", F.row_number().over(in_shard)).withColumn("of", F.count("*").over(of_shard))
        .withColumn("spare", F.col("capacity") - F.col("full"))
        .withColumn("room", F.expr("k * spare div of - (k - 1) * spare div of"))
    )
    none = F.lit(0).cast("long")
    events = ring.where("n > kept").select(
        "point", F.lit(0).alias("kind"), "shard", (F.col("n") - F.col("kept")).alias("sent"), none.alias("room"), F.col("kept").alias("base")
    ).unionByName(nodes.where("room > 0").select("point", F.lit(1).alias("kind"), "shard", none.alias("sent"), "room", F.col("full").alias("base")))
    # after the lowest level of the queue nobody waits: a turn that begins there needs no second lap
    around = Window.orderBy("point", "kind").rowsBetween(Window.unboundedPreceding, 0)
    turn = Window.orderBy("lap", "point", "kind")
    upto = turn.rowsBetween(Window.unboundedPreceding, 0)
    events = (
        events.withColumn("level", F.sum(F.col("sent") - F.col("room")).over(around))
        .withColumn("lowest", F.min(F.struct("level", "point", "kind")).over(whole))
        .withColumn("lap", (F.struct("point", "kind") <= F.struct("lowest.point", "lowest.kind")).cast("int"))
        .withColumn("sent_to", F.sum("sent").over(upto))
        .withColumn("net", F.sum(F.col("sent") - F.col("room")).over(upto))
        .withColumn("served_to", F.col("sent_to") - F.col("net") + F.least(none, F.min("net").over(upto)))
        .withColumn("served_from", F.coalesce(F.lag("served_to").over(turn), none))
    )
    events = cut_lineage(events)
    senders = events.where("kind = 0").select(
        (F.col("sent_to") - F.col("sent")).alias("a"), F.struct("point", "base", (F.col("sent_to") - F.col("sent")).alias("from"), F.col("sent_to").alias("to")).alias("s"))
    takers = events.where("kind = 1 and served_to > served_from").withColumn("taken", F.col("served_to") - F.col("served_from")).select(
        F.col("served_from").alias("a"),
        F.struct("shard", (F.col("base") + _before("taken", of_shard.orderBy("served_to"))).alias("slot"), F.col("served_from").alias("from"), F.col("served_to").alias("to")).alias("t"))
    # the queue is cut by senders and by takers; both cuts are laid over each other by their break points
    run = Window.orderBy("a").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        senders.join(takers, "a", "full")
        .withColumn("s", F.last("s", True).over(run)).withColumn("t", F.last("t", True).over(run))
        .withColumn("b", F.least("s.to", "t.to", F.lead("a").over(Window.orderBy("a"))))
        .where("b > a")
    )
    moved = pieces.select(
        "s.point", (F.col("s.base") + F.col("a") - F.col("s.from")).alias("lo"), (F.col("s.base") + F.col("b") - F.col("s.from")).alias("hi"),
        "t.shard", (F.col("t.slot") + F.col("a") - F.col("t.from")).alias("slot"), F.lit(True).alias("moved"))
    kept = ring.where("kept > 0").select("point", none.alias("lo"), F.col("kept").alias("hi"), "shard", "slot", F.lit(False).alias("moved"))
    return kept.unionByName(moved)


def assign(df: DataFrame, key: list[str], shards: int = 40, replicas: int = 48, slack: float = 0.0) -> DataFrame:
    """The rows of ``df`` in a column ``row`` with ``shard``, ``slot`` (gapless from 0 in its shard) and ``moved``.

    ``key`` names the columns that place a row; null counts as a value of its own and equal keys stand at one point, in
    any order among themselves. All columns of ``df`` stay inside ``row``, so no name can clash. An empty table gives an
    empty table. One shuffle of the rows, by ring point: points hold near equal numbers of distinct keys.
    """
    at = df.select(F.struct(*(df[c] for c in df.columns)).alias("row"), digits(*(df[c] for c in key)).alias("position"))
    at = at.withColumn("point", F.floor(F.col("position") / _SHIFT).cast("long"))
    counts = cut_lineage(at.groupBy("point").agg(F.count("*").alias("n")))
    plan = cut_lineage(placement(counts, shards, replicas, slack))
    order = Window.partitionBy("point").orderBy("position", *(F.col("row")[c] for c in key))
    ranked = at.withColumn("rank", F.row_number().over(order) - 1)
    # the plan has a few rows a point and POINTS is fixed, so this side is bounded
    return (
        ranked.join(F.broadcast(plan), "point").where("rank >= lo and rank < hi")
        .select("row", "shard", (F.col("slot") + F.col("rank") - F.col("lo")).alias("slot"), "moved")
    )


def op3_consistent_ring(spark, folder: str) -> DataFrame:
    """All documents over 40 shards whose row counts differ by one at most."""
    docs = table(spark, folder, "documents")
    # a null text has no bytes: size 16 and the checksum of the empty text
    narrow = docs.select(
        "doc_id", (byte_size(docs["text"]) + 16).alias("size"),
        F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = assign(narrow, ["doc_id", "text_crc32"])
    return placed.select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
