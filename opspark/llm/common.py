"""What the operators of this subpackage share: text columns, keyed hashing, batches, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opspark.session import cut_lineage

#: Bounds of an Arrow batch: rows, and bytes, so that long texts do not pile up in a Python worker.
BATCH_ROWS = 10_000
BATCH_BYTES = 4 << 20

#: Bytes of text that the array code handles at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

#: A word is a run of anything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def digits(*values: Column, width: int = 12) -> Column:
    """A non-negative long from the MD5 of the values as text: the same in any SQL engine.

    Null counts as the text ``\\N``.
    """
    text = F.concat_ws("|", *(F.coalesce(v.cast("string"), F.lit("\\N")) for v in values))
    return F.conv(F.substring(F.md5(text), 1, width), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


# --- hashing of words and shingles over the bytes of an Arrow text column ---------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, name: str, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[name] = have
    return have[:n]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column; null counts as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """Runs of rows with about ``size`` bytes of text each."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, words per row, and the running hash of the bytes."""
    n, rows = len(data), len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64), np.zeros(1, np.uint64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, "up", n), out=running[1:], dtype=np.uint64)
    return starts, ends, counts, running


def span_hashes(starts: np.ndarray, ends: np.ndarray, running: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span stands."""
    return mix((running[ends] - running[starts]) * _powers(_BASE_INVERSE, "down", len(running))[starts])


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each row, and how many each row has.

    A row with fewer words, but some, gives one: that of all its words.
    """
    many = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(counts)), many)
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[row]
    left = (first + counts)[row] - at
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    for j in range(k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + np.where(left > j, padded[at + j], np.uint64(0x2545F4914F6CDD1D)))
    return out, many


def shingle_sets(column: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) for each row of a text column."""
    data, offsets = texts_of(column)
    for start, stop in chunks(offsets):
        part = offsets[start : stop + 1]
        starts, ends, counts, running = words(data[part[0] : part[-1]], part - part[0])
        got, many = shingle_hashes(span_hashes(starts, ends, running), counts, k)
        at = np.concatenate([[0], np.cumsum(many)])
        for i in range(stop - start):
            yield start + i, np.unique(got[at[i] : at[i + 1]])


# --- connected components ---------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: every step is an aggregate and a join on the node, each round is
    written to the shared folder, and the rounds end when no edge changes. Nothing is held by the driver but counts.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = cut_lineage(edges)
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: the neighbours above a node go to the smallest of its neighbours and itself
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
            .select(F.col("w").alias("u"), F.col("low").alias("v")).where("u > v").distinct()
        )
        # small star: the neighbours below a node, and the node, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u")
        edges = cut_lineage(
            small.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u > v")
            .unionByName(least.select("u", F.col("low").alias("v")))
            .distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
