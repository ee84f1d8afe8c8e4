"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A hash rotates a vector pseudo-randomly (three rounds of random signs and a fast Hadamard transform) and takes the axis, with
sign, that it comes nearest to. Two such hashes make a table's key; a vector is filed under its first key and looks, by
multiprobe, also into the keys that its next nearest axes give. Rows that meet in a bucket of a table are compared there, in double
precision; only true links leave the bucket. Equal vectors are one class before anything is hashed, and a bucket that holds many
classes is compared in pairs of blocks, so no task ever holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from opspark.llm.common import components, small_batches, table
from opspark.session import cut_lineage

TABLES = 8
PROBES = 4

#: Classes of a bucket that are compared at once.
BLOCK = 512


def rotations(dim: int, count: int, seed: int = 11) -> np.ndarray:
    """Random signs (count, 3, width) for ``count`` rotations; width is dim filled up to a power of two."""
    width = 1 << max(1, (dim - 1).bit_length())
    return np.random.default_rng(seed).choice([-1.0, 1.0], (count, 3, width))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis."""
    n, h = x.shape[-1], 1
    while h < n:
        x = x.reshape(*x.shape[:-1], -1, 2, h)
        x = np.stack([x[..., 0, :] + x[..., 1, :], x[..., 0, :] - x[..., 1, :]], axis=-2)
        x = x.reshape(*x.shape[:-3], n)
        h *= 2
    return x


def nearest_axes(x: np.ndarray, signs: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis with sign, size) of the ``many`` largest rotated coordinates of each row."""
    y = np.zeros((len(x), signs.shape[-1]))
    y[:, : x.shape[1]] = x
    for s in signs:
        y = hadamard(y * s) / np.sqrt(y.shape[1])
    top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :many]
    size = np.take_along_axis(y, top, 1)
    return 2 * top + (size < 0), np.abs(size)


def keys(x: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Bucket keys (rows, tables, 1 + probes) of unit vectors; the first of a table is the vector's own.

    A table's key joins the axes of two rotations. Probes swap one axis or both for the next, in order of the size they lose.
    """
    signs = rotations(x.shape[1], 2 * tables)
    out = np.zeros((len(x), tables, 1 + probes), np.int64)
    many = min(4, signs.shape[-1])
    pairs = [(i, j) for i in range(many) for j in range(many)]
    for t in range(tables):
        a, a_size = nearest_axes(x, signs[2 * t], many)
        b, b_size = nearest_axes(x, signs[2 * t + 1], many)
        loss = np.stack([(a_size[:, 0] - a_size[:, i]) ** 2 + (b_size[:, 0] - b_size[:, j]) ** 2 for i, j in pairs], 1)
        loss[:, 0] = -1
        best = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
        key = np.stack([a[:, i] * (1 << 20) + b[:, j] for i, j in pairs], 1)
        got = np.take_along_axis(key, best, 1)
        out[:, t, : got.shape[1]] = got
        out[:, t, got.shape[1] :] = got[:, :1]
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (class_id, label, vector) once for each bucket that they are filed in or look into."""
    for b in batches:
        lengths = np.diff(b.column("vector").offsets.to_numpy())
        for dim in np.unique(lengths):
            take = np.flatnonzero(lengths == dim)
            part = b.take(pa.array(take))
            got = keys(unit(_vectors(part.column("vector"))))
            rows, tables, probes = got.shape
            at = np.repeat(np.arange(rows), tables * probes)
            yield pa.RecordBatch.from_arrays([
                part.column("class_id").take(pa.array(at)), part.column("label").take(pa.array(at)),
                pa.array(np.tile(np.repeat(np.arange(tables), probes), rows) * 1000 + dim % 1000, pa.int32()), pa.array(got.ravel()),
                pa.array(np.tile(np.arange(probes) > 0, rows * tables)),
            ], names=["class_id", "label", "side", "bucket", "looks"])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1)


def _links(threshold: float, rows: pa.Table) -> np.ndarray:
    """Linked pairs of classes within the buckets of a table that is sorted by bucket."""
    names = ["label", "side", "bucket", "low", "high"]
    columns = [rows.column(n).combine_chunks() for n in names]
    change = np.zeros(len(rows), bool)
    change[0] = True
    for c in columns:
        v = c.to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(rows))
    run_end = np.repeat(ends, ends - starts)
    ids, looks, block, low, high = (rows.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("class_id", "looks", "block", "low", "high"))
    x = unit(_vectors(rows.column("vector").combine_chunks()))

    def kept(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # filed with filed or looker; a pair of two blocks where both meet, a pair within a block where it meets itself
        ok = ~(looks[i] & looks[j]) & (ids[i] != ids[j])
        ok &= (np.minimum(block[i], block[j]) == low[i]) & (np.maximum(block[i], block[j]) == high[i])
        i, j = i[ok], j[ok]
        return np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], 1)

    found = []
    at = np.arange(len(rows))
    long = np.repeat(ends - starts, ends - starts) > 16
    for step in range(1, 16):  # short runs: all pairs so many rows apart, over all runs at once
        i = at[~long & (at + step < run_end)]
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[i], x[i + step]) >= threshold]
        found.append(kept(i, i + step))
    for start, end in zip(starts, ends):
        if end - start > 16:
            for part in range(start, end, BLOCK):
                i, j = np.nonzero(x[part : min(part + BLOCK, end)] @ x[start:end].T >= threshold)
                up = i + part < j + start
                found.append(kept(i[up] + part, j[up] + start))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _compare(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked pairs from rows sorted by bucket; the last bucket of a batch waits for the next."""

    def out(rows: pa.Table) -> pa.RecordBatch:
        # vectors of one length at a time
        length = pc.list_value_length(rows.column("vector"))
        pairs = np.concatenate([_links(threshold, rows.filter(pc.equal(length, n))) for n in pc.unique(length).to_pylist()])
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    names = ["label", "side", "bucket", "low", "high"]
    waiting: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        key = [tuple(b.column(n)[i].as_py() for n in names) for i in (0, -1)]
        if key[1] == last:
            waiting.append(b)
            continue
        rows = pa.Table.from_batches([*waiting, b])
        same = np.ones(b.num_rows, bool)
        for n, v in zip(names, key[1]):
            same &= b.column(n).to_numpy(zero_copy_only=False) == v
        cut = len(rows) - int(same.sum())
        if cut:
            yield out(rows.slice(0, cut))
        waiting, last = [b.slice(b.num_rows - int(same.sum()))], key[1]
    if waiting:
        yield out(pa.Table.from_batches(waiting))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, classes) of (row, vec_id, embedding, label), where ``row`` is a number of each row's own.

    ``members`` has (row, class_id): a class is the rows with one label and one vector, named by its smallest
    row. ``links`` has each pair of linked classes once (a < b). ``classes`` has (class_id, least, copies) with the smallest vec_id. Rows with a
    null label or vec_id, and vectors that are null, empty, zero or hold null or non-finite components, are in none of them. Repeated rows
    are copies of each other. Vectors of unlike lengths never link.
    """
    small_batches(vectors.sparkSession)
    # one zero: -0.0 and 0.0 are the same component
    vector = F.transform(F.col("embedding"), lambda v: F.when(v == 0, 0).otherwise(v)).cast(dict(vectors.dtypes)["embedding"])
    usable = (
        vectors.select("row", "vec_id", "label", vector.alias("vector"))
        .where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vector") > 0))
        .where(F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v)) & F.exists("vector", lambda v: v != 0))
    )
    keyed = usable.withColumn("digest", F.md5(F.concat_ws(",", F.transform("vector", lambda v: v.cast("string")))))
    grouped = keyed.groupBy("label", "digest").agg(
        F.min("row").alias("class_id"), F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    grouped = cut_lineage(grouped)
    names = grouped.select(F.col("label").alias("class_label"), F.col("digest").alias("class_digest"), "class_id")
    members = keyed.select("row", "label", "digest").join(
        names, (F.col("label") == F.col("class_label")) & (F.col("digest") == F.col("class_digest"))).select("row", "class_id")
    filed = cut_lineage(grouped.select("class_id", "label", "vector").mapInArrow(
        _hashed, f"class_id long, label {dict(vectors.dtypes)['label']}, side int, bucket long, looks boolean"))
    bucket = ["label", "side", "bucket"]
    # buckets that compare nothing go before any vector is sent, crowded ones are cut into blocks
    sizes = filed.groupBy(bucket).agg(F.count("*").alias("rows"), F.sum((~F.col("looks")).cast("long")).alias("own")).where("rows > 1 and own > 0")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    meets = (
        filed.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(other))
        .select(*bucket, "class_id", "looks", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    meets = meets.join(grouped.select("class_id", "vector"), "class_id")
    key = [*bucket, "low", "high"]
    links = meets.repartition(*key).sortWithinPartitions(*key).mapInArrow(partial(_compare, threshold), "a long, b long").distinct()
    return members, cut_lineage(links), grouped.select("class_id", "least", "copies")


def numbered(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, embedding, label): every row with a number of its own, written down so that it stays."""
    return cut_lineage(vectors.select("vec_id", "embedding", "label").withColumn("row", F.monotonically_increasing_id()))


def linked_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Rows are told apart by a number of their own, so rows of one vec_id with different vectors have their own links. A row
    that takes no part has no links and is its own component. A null vec_id takes no part: null component, not kept.
    """
    vectors = numbered(vectors)
    members, links, classes = near_duplicates(vectors)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = both.join(classes.select(F.col("class_id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    known = classes.join(partners, F.col("class_id") == F.col("a"), "left").join(components(links), F.col("class_id") == F.col("node"), "left")
    known = cut_lineage(known.select(
        F.col("class_id").alias("known_id"), "least", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class_id").alias("root")))
    roots = known.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    known = cut_lineage(known.join(roots, F.col("root") == F.col("of")).select("known_id", "n_links", "component_id"))
    placed = members.join(known, F.col("class_id") == F.col("known_id")).select(F.col("row").alias("member"), "n_links", "component_id")
    return vectors.select("row", "vec_id").join(placed, F.col("row") == F.col("member"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_cross_polytope(spark, folder: str) -> DataFrame:
    """Links and components of all embeddings; a vector without a link is its own component."""
    return linked_rows(table(spark, folder, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), c AS (
  SELECT vec_id AS n, vec_id AS r FROM embeddings
  UNION
  SELECT l.b AS n, c.r FROM c JOIN l ON c.n = l.a
), m AS (SELECT n, min(r) AS component_id FROM c GROUP BY n)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN m ON m.n = e.vec_id
"""
