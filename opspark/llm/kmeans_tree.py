"""Nearest neighbours by inner product: a hierarchical k-means tree, best bin first.

1. Equal vectors are one class; it keeps the ids that can matter, the k + 1 smallest. A coordinate added to each vector (the
   root of what its squared length is short of the longest one's) turns the largest inner product into the smallest distance.
2. The tree is fitted on a bounded sample of classes; a node with more sample vectors than a leaf holds is cut by k-means
   again, so dense regions get more leaves. Every class is then filed in the leaf that it comes down to.
3. A query goes down best bin first: a priority queue holds the nodes seen so far by distance, the nearest is opened next,
   and a leaf that comes out is visited, until as many leaves are visited as calibration asks for.
4. Calibration compares some queries with every class, ranks the leaves of their true neighbours in the order in which the queue
   gives them out, and widens the number of visits until the wanted share of true neighbours is met.
5. Leaves that lie side by side form bins of bounded size, and a large leaf is cut into blocks. A query is sent once to each bin
   that it visits and compared there with the leaves it visits. The sample in those leaves tells a score that enough classes
   reach for certain, so a bin gives back only what is above it; the best of all bins are joined and ranked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.llm.common import small_batches, table
from opspark.session import bounded_broadcast, cut_lineage

#: Most classes, give or take chance, that the tree is fitted on; more leaves need more of them.
SAMPLE = 40_000

#: Children of a node, sample vectors of a leaf at most, rounds of k-means.
BRANCH = 16
LEAF_SAMPLE = 32
ROUNDS = 8

#: Queries that calibration compares with all classes, and the share of their true neighbours that must be met.
CALIBRATION = 256
RECALL = 0.97

#: Classes of a bin or block, and queries that are compared with it at once.
BIN = 2_000
ASKING = 4_000

#: Queries with one vector from which on they are salted when results come back to them.
HOT = 10_000


@dataclass
class Tree:
    """Inner nodes: centres and, for each, the inner node (0 or more) or leaf (-1 - leaf) below it. Leaves stand in order of depth first."""

    centres: list[np.ndarray] = field(default_factory=list)
    below: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row comes down to."""
        at = np.zeros(len(x), np.int64)
        if not self.centres:
            return at
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                rows = np.flatnonzero(at == node)
                at[rows] = self.below[node][_nearest(x[rows], self.centres[node])]
        return -1 - at

    def visit(self, q: np.ndarray, many: int) -> list[int]:
        """The first ``many`` leaves, best bin first."""
        if not self.centres:
            return [0]
        out: list[int] = []
        queue = [(0.0, 0)]
        while queue and len(out) < many:
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                continue
            c = self.centres[node]
            gap = (c * c).sum(1) - 2 * (c @ q)
            for pair in zip(gap.tolist(), self.below[node].tolist()):
                heapq.heappush(queue, pair)
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * (x @ centres.T), axis=1)


def grow(x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF_SAMPLE, rounds: int = ROUNDS, seed: int = 5) -> Tree:
    """A tree over the rows of ``x``; rows that k-means can't part stay in one leaf."""
    tree, draw = Tree(), np.random.default_rng(seed)

    def cut(rows: np.ndarray) -> int:
        points = x[rows]
        if len(rows) > leaf:
            # no more children than fill half a leaf each
            centres = points[draw.choice(len(rows), min(branch, -(-2 * len(rows) // leaf)), replace=False)]
            for _ in range(rounds):
                near = _nearest(points, centres)
                used, near = np.unique(near, return_inverse=True)
                centres = np.stack([points[near == i].mean(0) for i in range(len(used))])
            near = _nearest(points, centres)
            used = np.unique(near)
            if len(used) > 1:
                node = len(tree.centres)
                tree.centres.append(centres[used])
                tree.below.append(np.zeros(len(used), np.int64))
                for i, u in enumerate(used):
                    tree.below[node][i] = cut(rows[near == u])
                return node
        tree.leaves += 1
        return -tree.leaves

    if len(x):
        cut(np.arange(len(x)))
    return tree


@dataclass
class Index:
    """A fitted tree with what turns vectors into its points, and its calibration."""

    tree: Tree
    width: int
    scale: float
    longest: float
    sample: np.ndarray | None = None  # the sample's vectors in order of leaf, and where each leaf's begin
    begins: np.ndarray | None = None
    visits: int = 1
    recall: float | None = None

    def points(self, x: np.ndarray) -> np.ndarray:
        """Vectors, made longer by the coordinate that fills up their length."""
        x = x / self.scale
        short = np.maximum(self.longest**2 - (x * x).sum(1), 0)
        return np.concatenate([x, np.sqrt(short)[:, None]], 1)

    def hold(self, x: np.ndarray) -> None:
        """Keep the sample by leaf."""
        leaf = self.tree.file(self.points(x))
        self.sample = x[np.argsort(leaf, kind="stable")]
        self.begins = np.searchsorted(np.sort(leaf), np.arange(self.tree.leaves + 1))

    def sure(self, q: np.ndarray, leaves: list[int], many: int) -> float:
        """A score that ``many`` classes of these leaves reach for certain: those of the sample that lie there."""
        parts = [self.sample[self.begins[i] : self.begins[i + 1]] for i in leaves]
        score = np.concatenate(parts) @ q if parts else np.zeros(0)
        if len(score) < many:
            return -np.inf
        # what is worked out elsewhere may differ in the last bits
        return float(np.partition(score, len(score) - many)[len(score) - many] - 1e-9 * (np.abs(score).max() + np.sqrt(q @ q) * self.longest * self.scale))

    def question(self, q: np.ndarray) -> np.ndarray:
        """A query, as long as the longest vector."""
        q = q / np.abs(q).max()
        return np.append(q * (self.longest / np.sqrt((q * q).sum())), 0.0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _filed(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their leaf; a vector of another length than the tree's goes to the leaf -length."""
    index = sent.value
    for b in batches:
        column = b.column("vector")
        length = np.diff(column.offsets.to_numpy())
        leaf = -length.astype(np.int64)
        own = np.flatnonzero(length == index.width)
        if len(own):
            leaf[own] = index.tree.file(index.points(_matrix(column.take(pa.array(own)))))
        yield pa.RecordBatch.from_arrays([b.column("class_id"), pa.array(leaf), b.column("ids"), column], names=["class_id", "leaf", "ids", "vector"])


def _best(many: int, score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of the ``many`` largest scores, ties to the smaller id."""
    if len(score) > 4 * many:
        edge = np.partition(score, len(score) - many)[len(score) - many]
        place = np.flatnonzero(score >= edge)
        return place[np.lexsort((first[place], -score[place]))[:many]]
    return np.lexsort((first, -score))[:many]


def _against_all(names: list[bytes], q: np.ndarray, many: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best classes of each calibration query among the rows of a task, itself not counted."""
    score = np.zeros((len(q), 0))
    leaf = np.zeros((len(q), 0), np.int64)
    for b in batches:
        length = np.diff(b.column("vector").offsets.to_numpy())
        part = b.take(pa.array(np.flatnonzero(length == q.shape[1])))
        if not part.num_rows:
            continue
        got = q @ _matrix(part.column("vector")).T
        place = {name: i for i, name in enumerate(part.column("class_id").to_pylist())}
        for i, name in enumerate(names):
            if name in place:
                got[i, place[name]] = -np.inf
        leaves = np.broadcast_to(part.column("leaf").to_numpy(), got.shape)
        score, leaf = np.concatenate([score, got], 1), np.concatenate([leaf, leaves], 1)
        top = np.argsort(-score, axis=1, kind="stable")[:, :many]
        score, leaf = np.take_along_axis(score, top, 1), np.take_along_axis(leaf, top, 1)
    row, column = np.nonzero(score > -np.inf)
    yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(leaf[row, column]), pa.array(score[row, column])], names=["query", "leaf", "score"])


def _routes(sent, bins: dict[int, tuple[int, int]], many: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class_id, bin, block, leaves, least, vector): each query once for each block of each bin that it visits.

    ``least`` is a score that ``many`` classes of the leaves visited reach, so nothing below it needs to come back.
    """
    index = sent.value
    for b in batches:
        ids, out_bin, out_block, out_leaves, out_least, row = b.column("class_id"), [], [], [], [], []
        for i, vector in enumerate(b.column("vector")):
            q = np.array(vector.as_py(), float)
            own = len(q) == index.width
            leaves = index.tree.visit(index.question(q), index.visits) if own else [-len(q)]
            least = index.sure(q, leaves, many) if own else -np.inf
            wanted: dict[tuple[int, int], list[int]] = {}
            for leaf in leaves:
                if leaf in bins:
                    place, blocks = bins[leaf]
                    for block in range(blocks):
                        wanted.setdefault((place, block), []).append(leaf)
            for (place, block), some in wanted.items():
                out_bin.append(place)
                out_block.append(block)
                out_leaves.append(some)
                out_least.append(least)
                row.append(i)
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.take(at), pa.array(out_bin, pa.int64()), pa.array(out_block, pa.int64()), pa.array(out_leaves, pa.list_(pa.int64())), pa.array(out_least, pa.float64()),
             b.column("vector").take(at)],
            names=["class_id", "bin", "block", "leaves", "least", "vector"])


def _compare(many: int, asking: pa.Table, filed: pa.Table) -> pa.Table:
    """The best classes of a block for each query sent there: (query, ids, score)."""
    found_row, found_place, found_score = [], [], []
    if len(asking) and len(filed):
        asking, filed = asking.combine_chunks(), filed.combine_chunks().sort_by("leaf")
        leaf = filed.column("leaf").to_numpy()
        first = filed.column("first").to_numpy()
        least = asking.column("least").to_numpy()
        x, q = (_matrix(t.column("vector").combine_chunks()) if _even(t) else None for t in (filed, asking))
        asked: dict[int, list[int]] = {}
        for i, some in enumerate(asking.column("leaves").to_pylist()):
            for one in some:
                asked.setdefault(one, []).append(i)
        per: list[list] = [[] for _ in range(len(asking))]
        for one, rows in asked.items():
            low, high = np.searchsorted(leaf, [one, one + 1])
            if low == high:
                continue
            a = q[rows] if q is not None else _matrix(asking.column("vector").combine_chunks().take(pa.array(rows)))
            c = x[low:high] if x is not None else _matrix(filed.column("vector").combine_chunks().slice(low, high - low))
            score = a @ c.T
            for j, i in enumerate(rows):
                good = np.flatnonzero(score[j] >= least[i])
                best = good[_best(many, score[j][good], first[low + good])]
                per[i].append((best + low, score[j][best]))
        for i, parts in enumerate(per):
            if parts:
                place, score = (np.concatenate(p) for p in zip(*parts))
                best = _best(many, score, first[place])
                found_row.append(np.full(len(best), i))
                found_place.append(place[best])
                found_score.append(score[best])
    if found_row:
        row, place, score = (np.concatenate(v) for v in (found_row, found_place, found_score))
        return pa.table({
            "query": asking.column("class_id").take(pa.array(row)), "ids": filed.column("ids").take(pa.array(place)), "score": pa.array(score)})
    return pa.table({"query": pa.array([], pa.binary()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})


def _even(t: pa.Table) -> bool:
    """Whether all vectors are of one length."""
    length = np.diff(t.column("vector").combine_chunks().offsets.to_numpy())
    return len(np.unique(length)) == 1


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, digest, vector) of the rows that take part."""
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.when(v == 0, 0.0).otherwise(v))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull() & (F.size("vector") > 0))
    rows = rows.where(F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v)) & F.exists("vector", lambda v: v != 0))
    return rows.withColumn("digest", F.unhex(F.md5(F.concat_ws(",", F.transform("vector", lambda v: v.cast("string"))))))


def _classes(rows: DataFrame, query: Column, k: int) -> DataFrame:
    """(class_id, vector, ids, asked): one row per vector with its k + 1 smallest ids and the number of queries that have it."""
    merged = rows.groupBy(F.col("digest").alias("class_id")).agg(F.first("vector").alias("vector"), F.sum(query.cast("long")).alias("asked"))
    # the limit on the row number is taken on either side of the shuffle, so a vector of many rows costs no task
    place = F.row_number().over(W.partitionBy("digest").orderBy("vec_id"))
    few = rows.select("digest", "vec_id").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    return merged.join(few.groupBy("digest").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), F.col("class_id") == F.col("digest")).drop("digest")


def fit(classes: DataFrame, sample: int = SAMPLE, leaf: int = LEAF_SAMPLE) -> Index | None:
    """The tree over a sample of (class_id, vector), taken by digest; None without rows.

    The sample holds about ``sample`` rows, all if there are fewer; it is what the driver holds.
    """
    width = classes.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return None
    own = classes.where(F.size("vector") == width["width"])
    scale = own.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + (v / scale) * (v / scale))
    longest = own.agg(F.max(F.sqrt(squares))).first()[0]
    part = F.conv(F.substring(F.hex("class_id"), 1, 8), 16, 10).cast("long")
    taken = own.where(part < int(min(1.0, sample / width["count"]) * (1 << 32))).select("class_id", "vector").toArrow().sort_by("class_id")
    index = Index(Tree(), width["width"], scale, longest)
    x = _matrix(taken.column("vector").combine_chunks()) if len(taken) else np.zeros((0, index.width))
    index.tree = grow(index.points(x), leaf=leaf) if len(x) else Tree(leaves=1)
    index.hold(x)
    return index


def calibrate(index: Index, filed: DataFrame, asking: DataFrame, k: int, queries: int = CALIBRATION, recall: float = RECALL) -> Index:
    """Sets ``visits``: the leaves that a query must visit for the wanted share of true neighbours of some queries.

    ``filed`` has (class_id, leaf, vector) of every class, ``asking`` (class_id, vector). The true neighbours are found among all rows.
    """
    some = asking.where(F.size("vector") == index.width).orderBy("class_id").limit(queries).collect()
    if not some:
        return index
    q = np.array([r["vector"] for r in some], float)
    best = filed.mapInArrow(partial(_against_all, [bytes(r["class_id"]) for r in some], q, k), "query long, leaf long, score double")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "leaf"))
    true = best.withColumn("place", place).where(F.col("place") <= k).select("query", "leaf").collect()
    position = {}
    for i in {r["query"] for r in true}:
        position[i] = {leaf: n for n, leaf in enumerate(index.tree.visit(index.question(q[i]), index.tree.leaves))}
    met = np.array([position[r["query"]][r["leaf"]] for r in true]) if true else np.zeros(0)
    index.visits = 1
    while len(met) and (met < index.visits).mean() < recall:
        index.visits += max(1, index.visits // 8)
    index.recall = float((met < index.visits).mean()) if len(met) else None
    return index


def _bins(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(bin, blocks) of each leaf: leaves side by side as far as a bin goes, blocks for a leaf beyond it."""
    out, now, held = {}, 0, 0
    for leaf in sorted(sizes):
        if held and held + sizes[leaf] > BIN:
            now, held = now + 1, 0
        held += sizes[leaf]
        out[leaf] = (now, -(-sizes[leaf] // BIN))
        if out[leaf][1] > 1:
            now, held = now + 1, 0
    return out


def nearest(vectors: DataFrame, query: Column, k: int = 20, sample: int = SAMPLE, recall: float = RECALL) -> tuple[DataFrame, Index | None]:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each query, and the index.

    ``vectors`` has vec_id and embedding; ``query`` tells by vec_id which rows ask. Vectors that are null, empty, zero or hold null
    or non-finite components, and rows without vec_id, take no part. Vectors of unlike lengths are not compared; those
    of a rare length are compared with all of their length. Repeated rows count once; an id with several vectors
    asks with each of them and is no neighbour of itself. Ties go to the smaller vec_id. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    empty = "query_id long, rank int, vec_id long, score double"
    rows = _usable(vectors)
    classes = cut_lineage(_classes(rows, query, k))
    index = fit(classes, sample)
    asking = classes.where("asked > 0")
    if index is None or asking.isEmpty():
        return spark.createDataFrame([], empty), index
    sent = spark.sparkContext.broadcast(index)  # the tree and its sample, of bounded size
    filed = cut_lineage(classes.select("class_id", "ids", "vector").mapInArrow(
        partial(_filed, sent), "class_id binary, leaf long, ids array<long>, vector array<double>"))
    index = calibrate(index, filed, asking, k, recall=recall)
    # one row per leaf, of which there are no more than the sample allows
    bins = _bins({r["leaf"]: r["count"] for r in filed.groupBy("leaf").count().collect()})
    sent = spark.sparkContext.broadcast(index)  # calibrated now
    routes = cut_lineage(asking.select("class_id", "vector").mapInArrow(
        partial(_routes, sent, bins, k + 1), "class_id binary, bin long, block long, leaves array<long>, least double, vector array<double>"))

    # crowds of queries of a block are compared apart
    crowd = F.ceil(F.count("*") / ASKING).cast("int").alias("crowds")
    crowds = F.broadcast(cut_lineage(routes.groupBy("bin", "block").agg(crowd)))  # a row per block of a bin
    asks = routes.join(crowds, ["bin", "block"]).withColumn("crowd", F.pmod(F.xxhash64("class_id"), F.col("crowds")).cast("int"))
    places = F.broadcast(spark.createDataFrame([(leaf, b, n) for leaf, (b, n) in bins.items()], "leaf long, bin long, blocks int"))
    stock = filed.join(places, "leaf").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks").cast("long")))
    stock = stock.join(crowds, ["bin", "block"]).withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)))
    key = ["bin", "block", "crowd"]
    left = asks.select(*key, "class_id", "leaves", "least", "vector").groupBy(*key)
    right = stock.select(*key, "leaf", F.col("ids")[0].alias("first"), "ids", "vector").groupBy(*key)
    met = left.cogroup(right).applyInArrow(lambda asking, filed: _compare(k + 1, asking, filed), "query binary, ids array<long>, score double")
    near = met.select("query", F.explode("ids").alias("vec_id"), "score")
    order = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    top = near.withColumn("place", order).where(F.col("place") <= k + 1)
    lists = cut_lineage(top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list")))

    hot = bounded_broadcast(classes.where(F.col("asked") > HOT).select(F.col("class_id").alias("hot_id"), F.ceil(F.col("asked") / HOT).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    asked = rows.where(query).select(F.col("vec_id").alias("query_id"), F.col("digest").alias("of")).distinct()
    asked = asked.join(hot, F.col("of") == F.col("hot_id"), "left").withColumn("salt", F.pmod(F.xxhash64("query_id"), salts).cast("int")).select("query_id", "of", "salt")
    lists = lists.join(hot, F.col("query") == F.col("hot_id"), "left").withColumn("part", F.explode(F.sequence(F.lit(0), salts - 1))).select("query", "list", "part")
    both = asked.join(lists, (F.col("of") == F.col("query")) & (F.col("salt") == F.col("part")))
    own = F.slice(F.filter("list", lambda r: r["vec_id"] != F.col("query_id")), 1, k)
    out = both.select("query_id", F.posexplode(own).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score"), index


def op13_kmeans_tree(spark, folder: str) -> DataFrame:
    """The 20 nearest rows found of each row whose vec_id is divisible by 20."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)[0]
