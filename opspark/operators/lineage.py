"""Lineage of datasets and runs, and time spent in traces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from opspark.functions.columns import safe_ratio
from opspark.operators.store import seconds
from opspark.session import BROADCAST_ROWS, cut_lineage, fits


def lineage_edges(events: DataFrame, task: str = "task", run: str = "run_id", dataset: str = "dataset",
                  kind: str = "kind") -> DataFrame:
    """Edges dataset -> task for inputs and task -> dataset for outputs, per run.

    Keeping the dataset between its producers and consumers gives the same
    reachability as producer-consumer pairs without forming those pairs.
    """
    reads = F.col(kind) == "input"
    return events.select(
        F.when(reads, F.col(dataset)).otherwise(F.col(task)).alias("src"),
        F.when(reads, F.col(task)).otherwise(F.col(dataset)).alias("dst"), F.col(run).alias("run_id")).distinct()


#: Rounds whose new pairs are kept apart before they are merged into one table.
APART = 8

#: Rounds before the chains of a graph are contracted.
PLAIN = 6


def chains(links: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edges, inner)``: a graph in which every chain is one edge, and the nodes inside the chains.

    ``links`` has distinct (_from, _to). A node with one link in and one out, and not among ``ends`` (node), is inside a chain. ``edges`` has
    (_from, _to, hops) between the other nodes, ``inner`` (first, node, hops) with the node that a chain starts from and the steps from
    there. Steps back are doubled each round, so a chain of n nodes takes log2(n) rounds.
    """
    into = links.groupBy(F.col("_to").alias("node")).agg(F.count("*").alias("ins"), F.min("_from").alias("at")).where("ins = 1")
    out = links.groupBy(F.col("_from").alias("node")).agg(F.count("*").alias("outs")).where("outs = 1").select("node")
    passing = into.join(out, "node", "left_semi").join(ends.select("node"), "node", "left_anti").where("at <> node")
    back = cut_lineage(passing.select("node", "at", F.lit(1).cast("bigint").alias("hops"), F.lit(False).alias("done")))
    size, reach = back.count(), 1
    while reach <= size:
        ahead = back.select(F.col("node").alias("_node"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), F.col("done").alias("_done"))
        moved = back.where("not done").join(ahead, F.col("at") == F.col("_node"), "left").select(
            back["node"], F.coalesce("_at", "at").alias("at"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.coalesce("_done", F.lit(True)).alias("done"))
        back = cut_lineage(back.where("done").unionByName(moved))
        reach *= 2
        if back.where("not done").isEmpty():
            break
    # what is left is a ring that nothing leads into
    inner = back.where("done").select(F.col("at").alias("first"), "node", "hops")
    ring = back.where("not done").select("node")
    last = inner.select(F.col("node").alias("_from"), "first", F.col("hops").alias("_inside"))
    edges = links.join(ring.select(F.col("node").alias("_from")), "_from", "left_anti").join(last, "_from", "left").join(
        inner.select(F.col("node").alias("_to")), "_to", "left_anti")
    edges = edges.select(F.coalesce("first", "_from").alias("_from"), "_to", (F.coalesce("_inside", F.lit(0)) + 1).alias("hops"))
    return edges.groupBy("_from", "_to").agg(F.min("hops").alias("hops")), inner


def closure(edges: DataFrame, roots: DataFrame | None = None, upstream: bool = False) -> DataFrame:
    """Every node reachable from each root with its smallest depth, as ``(root, node, depth)``.

    Each round follows the newest pairs only, keeps those that are new or nearer than before, and ends when there are none, so cycles
    end. A graph that goes on after some rounds has its chains without branches contracted, so a deep graph takes as many rounds as it has
    branchings in a row, not levels, and a flat one is not charged for it. Pairs of the last rounds are merged into one table now and then;
    a round reads that and a few more. Without ``roots`` every node that links on is a root of its own, and nothing can be contracted.
    """
    a, b = ("dst", "src") if upstream else ("src", "dst")
    # written once, so no round computes the edges again
    links = cut_lineage(edges.select(F.col(a).alias("_from"), F.col(b).alias("_to")).where(
        "_from is not null and _to is not null").distinct())
    start = links.select(F.col("_from").alias("root")) if roots is None else roots.select(F.col(roots.columns[0]).alias("root")).where("root is not null")
    newest = cut_lineage(start.distinct().select("root", F.col("root").alias("node"), F.lit(0).cast("bigint").alias("depth")))
    steps, inner = links.withColumn("hops", F.lit(1).cast("bigint")), None
    merged, recent, rounds, pairs, nodes = newest, [], 0, 0, 0
    while True:
        if rounds == PLAIN and roots is not None:
            # the newest nodes are ends of chains, so the search goes on from where it is
            steps, inner = chains(links, newest.select("node").union(start.select("root")).distinct())
            steps = cut_lineage(steps)
        seen = reduce(DataFrame.unionByName, [merged, *recent])
        # a small table of pairs is shuffled sooner than nodes are counted
        ahead = _few_ahead(newest, steps) if pairs > BROADCAST_ROWS and nodes <= BROADCAST_ROWS // 2 else None
        if ahead is not None:
            # only pairs with a node that is met now can be met again
            seen = seen.join(F.broadcast(ahead.select(F.col("_to").alias("_at")).distinct()), F.col("node") == F.col("_at"), "left_semi")
        step = newest.join(steps if ahead is None else F.broadcast(ahead), F.col("node") == F.col("_from")).select("root", F.col("_to").alias("node"), (F.col("depth") + F.col("hops")).alias("depth"))
        # pairs met before and pairs met now are held against each other in one aggregate
        both = step.unionByName(seen.withColumnRenamed("depth", "before"), allowMissingColumns=True).groupBy("root", "node").agg(F.min("depth").alias("depth"), F.min("before").alias("before"))
        newest = cut_lineage(both.where("depth < before or depth is not null and before is null").drop("before"))
        new, nodes = newest.agg(F.count("*"), F.approx_count_distinct("node")).first()
        rounds, pairs = rounds + 1, pairs + new
        if not new:
            break
        recent.append(newest)
        if len(recent) == APART:
            merged, recent = cut_lineage(_nearest([merged, *recent])), []
    # without chains a round is a level, and no pair is met again
    found = reduce(DataFrame.unionByName, [merged, *recent])
    if inner is not None:
        found = _nearest([merged, *recent])
        held = inner.withColumnRenamed("node", "_node")
        inside = found.join(held, F.col("node") == F.col("first")).select("root", F.col("_node").alias("node"), (F.col("depth") + F.col("hops")).alias("depth"))
        found = _nearest([found, inside])
    return found.where("depth > 0").withColumn("depth", F.col("depth").cast("int"))


def _few_ahead(newest: DataFrame, steps: DataFrame) -> DataFrame | None:
    """The steps that go on from the newest nodes, if those nodes and steps are counted to be few; many pairs may share a node."""
    nodes = cut_lineage(newest.select(F.col("node").alias("_at")).distinct())
    if not fits(nodes):
        return None
    ahead = cut_lineage(steps.join(F.broadcast(nodes), F.col("_from") == F.col("_at"), "left_semi"))
    return ahead if fits(ahead) else None


def _nearest(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("root", "node").agg(F.min("depth").alias("depth"))


def job_listing(runs: DataFrame, job: str = "job", ts: str = "ts", state: str = "state", tie_break: str | None = None) -> DataFrame:
    """Runs, last run time and last state per job."""
    order = F.struct(F.col(ts), *([F.col(tie_break)] if tie_break else []))
    return runs.groupBy(job).agg(F.count("*").alias("runs"), F.max(ts).alias("last_run"),
                                 F.max_by(state, order).alias("last_state"))


def deploy_gate(candidates: DataFrame, validations: DataFrame, run: str = "run_id", passed: str = "passed") -> DataFrame:
    """Only the candidates whose run passed validation."""
    good = validations.where(F.col(passed)).select(run).distinct()
    return candidates.join(good, run, "left_semi")


def span_breakdown(spans: DataFrame) -> DataFrame:
    """Total and self time per trace and component with the share of the trace's self time.

    Child time is summed per parent first; the share is taken over one row per
    component, never over the spans of a trace.
    """
    took = seconds(F.col("end")) - seconds(F.col("start"))
    timed = spans.select("trace_id", "span_id", "parent_id", "name", took.alias("_t"))
    inner = timed.where("parent_id is not null").groupBy(
        F.col("trace_id").alias("_trace"), F.col("parent_id").alias("_parent")).agg(F.sum("_t").alias("_inner"))
    both = timed.join(inner, (F.col("trace_id") == F.col("_trace")) & (F.col("span_id") == F.col("_parent")), "left")
    per = both.groupBy("trace_id", "name").agg(
        F.count("*").alias("spans"), F.sum("_t").alias("total_time"),
        F.sum(F.col("_t") - F.coalesce("_inner", F.lit(0.0))).alias("self_time"))
    return per.withColumn("share", safe_ratio(F.col("self_time"), F.sum("self_time").over(W.partitionBy("trace_id"))))
