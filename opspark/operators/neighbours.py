"""Exact nearest donors for gap filling, by a partition tree that is built and searched in tables.

The tree is built level by level: a node with more rows than a leaf holds is cut at quantiles along its two widest coordinates, all nodes of a
level in one aggregate and one join, so the number of leaves is free and their size is not. Donors that lack
coordinates have trees of their own, one per pattern of what they have.

The search goes down level by level as well, with rows (gap, node). A node's extent bounds the distance from both sides: ``k`` donors are
sure to lie within the reach that the nodes' far ends give, and nodes whose near end is beyond the reach are left out. What is
left at the leaves holds the nearest donors, so the result is that of a full search.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.session import bounded_broadcast, cut_lineage

#: Parts of a node along each of its two widest coordinates; their product is a hexadecimal digit.
FAN = 4

#: Gaps that visit a leaf beyond which they are spread over tasks, each having about so many.
CROWD = 20_000


def _extents(others: Sequence[str]) -> list[Column]:
    """Rows, least and greatest value of each coordinate."""
    return [F.count("*").alias("n"), F.array(*[F.min(c) for c in others]).alias("lo"), F.array(*[F.max(c) for c in others]).alias("hi")]


def _cuts(others: Sequence[str], leaf: int) -> Column:
    """Where a node is cut: two coordinates with the values of each, from its spreads and quantiles; null for a leaf."""
    spreads = F.array(*[F.struct((-F.coalesce(F.col("spread")[i], F.lit(0.0))).alias("s"), F.lit(i).alias("i")) for i in range(len(others))])
    ordered = F.array_sort(spreads)

    def along(place: int) -> Column:
        at = F.get(ordered, F.lit(place))
        axis = at["i"]
        # values that leave nothing above them cut nothing off; if none is left, the least value does
        inner = F.array_distinct(F.filter(F.get(F.col("marks"), axis), lambda v: v < F.get(F.col("hi"), axis)))
        values = F.when(at["s"].isNull() | (at["s"] == 0), F.array().cast("array<double>")).when(F.size(inner) > 0, inner).otherwise(F.array(F.get(F.col("lo"), axis)))
        return F.struct(axis.alias("axis"), values.alias("values"))

    wide = F.get(ordered, F.lit(0))["s"] < 0
    return F.when((F.col("n") > leaf) & wide, F.struct(along(0).alias("first"), along(1).alias("second")))


def partition_tree(donors: DataFrame, others: Sequence[str], leaf: int) -> tuple[list[DataFrame], DataFrame]:
    """``(levels, placed)``: (node, parent, n, lo, hi, open) of each level's nodes, and the donors with the leaf they lie in."""
    quantiles = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    pattern = F.concat_ws("", *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in others])
    rows = cut_lineage(donors.withColumn("node", F.concat(pattern, F.lit(":"))))
    levels, done = [], []
    while True:
        spread = F.array(*[F.stddev_pop(c) for c in others]).alias("spread")
        marks = F.array(*[F.percentile_approx(c, quantiles, F.lit(2000)) for c in others]).alias("marks")
        nodes = rows.groupBy("node").agg(*_extents(others), spread, marks).withColumn("cut", _cuts(others, leaf))
        nodes = cut_lineage(nodes.withColumn("open", F.col("cut").isNotNull()).select("node", "n", "lo", "hi", "open", "cut"))
        levels.append(nodes.drop("cut").withColumn("parent", F.expr("left(node, length(node) - 1)")))
        if not nodes.where("open").isEmpty():
            cut = bounded_broadcast(nodes.where("open").select(F.col("node").alias("_node"), "cut"))
            met = rows.join(cut, F.col("node") == F.col("_node"), "left")

            def side(cut_of: str) -> Column:
                value = F.get(F.array(*others), F.col(f"cut.{cut_of}.axis"))
                return F.size(F.filter(f"cut.{cut_of}.values", lambda v: v < value))

            child = side("first") * FAN + side("second")
            moved = cut_lineage(met.withColumn("child", F.when(F.col("cut").isNotNull(), F.concat("node", F.lower(F.hex(child))))).drop("_node", "cut"))
            done.append(moved.where("child is null").drop("child"))
            rows = moved.where("child is not null").drop("node").withColumnRenamed("child", "node").select(*rows.columns)
        else:
            done.append(rows)
            return levels, reduce(DataFrame.unionByName, done)


def _bounds(others: Sequence[str]) -> tuple[Column, Column]:
    """(near, far): between which the mean squared gap over the common coordinates lies for donors of a node."""
    near, far, common = F.lit(0.0), F.lit(0.0), F.lit(0)
    for i, c in enumerate(others):
        lo, hi = F.col("lo")[i], F.col("hi")[i]
        both = F.col(c).isNotNull() & lo.isNotNull()
        below, above = lo - F.col(c), F.col(c) - hi
        gap = F.greatest(below, above, F.lit(0.0))
        most = F.greatest(F.abs(below), F.abs(above))
        near = near + F.when(both, gap * gap).otherwise(0.0)
        far = far + F.when(both, most * most).otherwise(0.0)
        common = common + F.when(both, 1).otherwise(0)
    return F.try_divide(near, common.cast("double")), F.try_divide(far, common.cast("double"))


def _within_reach(frontier: DataFrame, others: Sequence[str], k: int) -> DataFrame:
    """The rows (gap, node) whose nodes may hold one of the ``k`` nearest donors of the gap."""
    near, far = _bounds(others)
    # a donor that shares no coordinate has no distance
    bounded = frontier.withColumn("near", near).withColumn("far", far).where("near is not null")
    by = W.partitionBy("_key")
    sure = F.sum("n").over(by.orderBy("far", "node").rowsBetween(W.unboundedPreceding, W.currentRow))
    marked = bounded.withColumn("sure", sure)
    reach = F.min(F.when(F.col("sure") >= k, F.col("far"))).over(by)
    kept = marked.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("near") <= F.col("reach") * (1 + 1e-9)))
    return kept.drop("near", "far", "sure", "reach")


def leaf_visits(gaps: DataFrame, levels: list[DataFrame], others: Sequence[str], k: int) -> DataFrame:
    """(_key, coordinates, node): the leaves that each gap has to look into."""
    one = F.lit(0).alias("_one")
    roots = bounded_broadcast(levels[0].drop("parent").withColumn("_one", one))  # a row per pattern of coordinates
    frontier = cut_lineage(_within_reach(gaps.withColumn("_one", one).join(roots, "_one").drop("_one"), others, k))
    for nodes in levels[1:]:
        below = nodes.toDF(*[f"_{c}" for c in nodes.columns])
        opened = frontier.where("open").select("_key", *others, F.col("node").alias("_at"))
        stepped = opened.join(bounded_broadcast(below), F.col("_at") == F.col("_parent")).select(
            "_key", *others, *[F.col(f"_{c}").alias(c) for c in ("node", "n", "lo", "hi", "open")])
        frontier = cut_lineage(_within_reach(frontier.where("not open").unionByName(stepped.select(*frontier.columns)), others, k))
    return frontier.select("_key", *others, "node")


def nearest_means(
    base: DataFrame, key: str, target: str, others: Sequence[str], total: int, k: int, leaf: int
) -> DataFrame:
    """``(_key, _fill)``: mean target of the ``k`` nearest donors for rows lacking the target."""
    spark = base.sparkSession
    others = list(others)
    empty = spark.createDataFrame([], f"_key {base.schema[key].dataType.simpleString()}, _fill double")
    if not others:
        return empty
    has_coordinate = F.coalesce(*[F.col(c) for c in others]).isNotNull()
    gaps = base.where(F.col(target).isNull() & has_coordinate).select(F.col(key).alias("_key"), *others)
    donors = base.where(F.col(target).isNotNull() & has_coordinate)
    # equal coordinates: only the k smallest keys can be chosen (limited before the shuffle)
    place = F.row_number().over(W.partitionBy(*others).orderBy(key))
    donors = donors.withColumn("_place", place).where(F.col("_place") <= k).select(F.col(key).alias("_donor"), F.col(target).alias("_value"), *others)
    levels, placed = partition_tree(donors, others, leaf)
    visits = cut_lineage(leaf_visits(gaps, levels, others, k))

    # leaves that many gaps look into are copied, so that the gaps spread
    crowded = visits.groupBy("node").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("salts")).where("salts > 1")
    crowded = bounded_broadcast(cut_lineage(crowded))
    salts = F.coalesce("salts", F.lit(1))
    visits = visits.join(crowded, "node", "left").withColumn("_salt", F.pmod(F.xxhash64("_key"), salts).cast("int")).drop("salts")
    packed = placed.groupBy("node").agg(  # at most a leaf of donors, or the equal ones of one place
        F.collect_list(F.struct(F.col("_donor").alias("k"), F.col("_value").alias("v"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(others)])).alias("_donors"))
    packed = packed.join(crowded, "node", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")

    def scored(donor):
        squares, common = F.lit(0.0), F.lit(0)
        for i, c in enumerate(others):
            gap = F.col(c) - donor[f"x{i}"]
            squares = squares + F.coalesce(gap * gap, F.lit(0.0))
            common = common + F.when(gap.isNotNull(), 1).otherwise(0)
        return F.struct(F.try_divide(F.lit(float(total)) * squares, common.cast("double")).alias("d"),
                        donor["k"].alias("k"), donor["v"].alias("v"))

    best = F.slice(F.array_sort(F.filter(F.transform("_donors", scored), lambda s: s["d"].isNotNull())), 1, k)
    found = visits.join(packed, ["node", "_salt"]).select("_key", F.explode(best).alias("s"))
    place = F.row_number().over(W.partitionBy("_key").orderBy("s.d", "s.k"))
    return (
        found.withColumn("_place", place).where(F.col("_place") <= k)
        .groupBy("_key").agg(F.avg("s.v").alias("_fill"))
    )
