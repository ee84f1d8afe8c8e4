"""Similarity join of texts by the Jaccard similarity of their word n-gram sets, with a rare-first prefix filter.

1. A text's set is hashed to 64 bits; texts with equal sets are one class, named by the digest of the set.
2. A fixed-size sketch counts n-grams over all texts. Its counts, then the hash, order the n-grams of each set: rare first.
3. Two sets that are similar enough share some n-grams of their first ones (prefix filter; for the shorter set a shorter prefix does,
   which also holds back what the positional filter would): with ``MEETS - 1`` n-grams more in each prefix at least ``MEETS`` of them.
   Classes meet on prefix n-grams, in order of length, and a chain ends where lengths are too unlike (length filter). One task reads
   an n-gram's classes as a sorted stream. A short chain gives its pairs, and pairs that meet less than ``MEETS`` times go: texts
   that share an n-gram by chance would join more and more of a growing table. Of a longer chain only the head is kept,
   so a frequent n-gram costs no memory and gives one row per class, not all pairs; whatever it joins stays.
4. Classes that are joined so are candidates of each other. A group of them is compared once, whatever number of
   n-grams its members share; a large group is cut into blocks, and pairs of blocks are compared apart (sets travel as
   sorted hashes). Inside, intersections of all pairs are counted exactly, so each pair is verified once.
5. A block gives the spanning links of its true links, and alternating star steps join them to components.

Hashes stand for n-grams: two different n-grams of a pair of texts are taken for one with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opspark.llm.common import components, mix, shingle_sets, small_batches, table
from opspark.session import bounded_broadcast, cut_lineage

#: Counters of the sketch; its size is fixed, whatever the input. A task sends them in strips, one byte each: counts
#: above 255 in one task are sent as 255, which matters to the order of n-grams only, and so to speed.
SKETCH = 1 << 22
STRIP = 1 << 14

#: Bits that tell whether a class may be a candidate, for the pass that sends sets; fixed too.
BITS = 1 << 20

#: N-grams of their prefixes that two similar sets share at least, and the longest chain that gives its pairs.
MEETS = 4
SHORT = 16

#: Bounds of a block of candidates.
BLOCK_SHINGLES = 2_000_000
BLOCK_CLASSES = 1500

#: Classes whose places may be broadcast (three numbers each), so that sets travel once; beyond, the join shuffles them once more.
PLACED = 1_000_000


def _digest(found: np.ndarray) -> int:
    """A digest of a set, as a signed long."""
    with np.errstate(over="ignore"):
        return int((mix(found + np.uint64(0x9E37)).sum(dtype=np.uint64) + mix(found).sum(dtype=np.uint64) * np.uint64(31) + np.uint64(len(found))).view(np.int64))


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _buckets(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(SKETCH - 1)).astype(np.int64)


def _sets(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and class of each text, and the sketch of the partition, over each class once, in strips."""
    counts, seen = np.zeros(SKETCH, np.int32), set()
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("strip", pa.int32()), ("counts", pa.binary())])
    for b in batches:
        n, name = [], []
        for _, found in shingle_sets(b.column("text"), k):
            n.append(len(found))
            name.append(_digest(found) if len(found) else None)
            if len(found) and name[-1] not in seen:
                seen.add(name[-1])
                np.add.at(counts, _buckets(found), 1)
        rows = len(n)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(name, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], schema=schema)
    if seen:
        strips = np.minimum(counts, 255).astype(np.uint8).reshape(-1, STRIP)
        rows = len(strips)
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(rows, pa.int64()) for _ in range(3)), pa.array(np.arange(rows), pa.int32()), pa.array([s.tobytes() for s in strips], pa.binary())], schema=schema)


def _strip_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the strips of each number; a partition's rows are read as a stream."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for number, counts in zip(b.column("strip").to_pylist(), b.column("counts")):
            sums.setdefault(number, np.zeros(STRIP, np.int64))
            sums[number] += np.frombuffer(counts.as_buffer(), np.uint8)
    if sums:
        yield _batch({"strip": pa.array(list(sums), pa.int32()), "counts": pa.array([np.minimum(v, 1 << 30).astype(np.int32).tobytes() for v in sums.values()], pa.binary())})


def _common(n: int, percent: int) -> int:
    """N-grams that the shorter set of a similar pair, of size ``n``, has in common with the longer at least."""
    return -(-2 * percent * n // (100 + percent))


def _prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """(index, probe): in how many first n-grams the shorter set of a pair meets the longer ``MEETS`` times, and the longer the shorter."""
    return min(n, n - _common(n, percent) + MEETS), min(n, n - -(-percent * n // 100) + MEETS)


def _prefixes(k: int, percent: int, sketch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n, late, class) for the prefix of each class, once in a partition; ``late`` = beyond the index prefix."""
    counts, seen = sketch.value, set()
    for b in batches:
        parts: list[tuple] = []
        for _, found in shingle_sets(b.column("text"), k):
            n = len(found)
            # below this size no other set is similar enough
            if n * (100 - percent) < percent:
                continue
            name = _digest(found)
            if name in seen:
                continue
            seen.add(name)
            index, probe = _prefix_sizes(n, percent)
            # found is sorted, so a stable sort puts equal counts in the order of the hash
            first = np.argsort(counts[_buckets(found)], kind="stable")[:probe]
            parts.append((found[first].view(np.int64), np.full(probe, n, np.int32), np.arange(probe) >= index, np.full(probe, name, np.int64)))
        if parts:
            yield _batch(dict(zip(("token", "n", "late", "class"), map(np.concatenate, zip(*parts)))))


def _chains(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges (a, b, times) from rows sorted by token, n, late.

    A chain goes on while a row's length is near enough to that of the last row with an index prefix. Up to ``SHORT`` rows give each pair that may
    be similar, once; a longer chain gives each class with its head, as met often enough. All that is carried from row to row is
    the token, the head, that length and the rows of a short chain.
    """
    token = head = reach = None
    chain: list[tuple[int, int, bool]] | None = []
    edges: dict[tuple[int, int], int] = {}

    def end() -> None:
        for i, (a, n, late) in enumerate(chain or ()):
            if late:
                continue
            # small sets may have less than MEETS in common
            times = 1 if _common(n, percent) >= MEETS else MEETS
            for b, m, _ in chain[i + 1 :]:
                if n * 100 < percent * m:
                    break
                if a != b:
                    pair = (a, b) if a < b else (b, a)
                    edges[pair] = edges.get(pair, 0) + times

    def out() -> pa.RecordBatch:
        a, b = map(np.array, zip(*edges))
        got = _batch({"a": a, "b": b, "times": pa.array(edges.values(), pa.int64())})
        edges.clear()
        return got

    for batch in batches:
        tokens, sizes, late, names = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "n", "late", "class"))
        # rows whose token stands alone give nothing: skip them at once
        alone = np.ones(len(tokens), bool)
        same = tokens[1:] == tokens[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        alone[:1] = alone[-1:] = False
        for i in np.flatnonzero(~alone):
            name, n = int(names[i]), int(sizes[i])
            if tokens[i] == token and head is not None and reach * 100 >= percent * n:
                if chain is not None and len(chain) == SHORT:
                    edges.update(((head, c[0]), MEETS) for c in chain if c[0] != head)
                    chain = None
                if chain is not None:
                    chain.append((name, n, bool(late[i])))
                elif name != head:
                    edges[head, name] = MEETS
                if not late[i]:
                    reach = n
                continue
            end()
            token, head, reach, chain = tokens[i], None, None, []
            if not late[i]:
                head, reach = name, n
                chain.append((name, n, False))
        if edges:
            yield out()
    end()
    if edges:
        yield out()


def _wanted(sets_of, bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, found) of the classes whose bit is set, once in a partition."""
    have, seen = bits.value, set()
    for b in batches:
        names, sets = [], []
        for name, found in sets_of(b.column("text"), lambda n: have[n % BITS] and n not in seen):
            seen.add(name)
            names.append(name)
            sets.append(found)
            if len(sets) >= 1024:
                yield _batch({"class": np.array(names), "found": pa.array(sets, pa.binary())})
                names, sets = [], []
        if names:
            yield _batch({"class": np.array(names), "found": pa.array(sets, pa.binary())})


def _text_sets(k: int, column: pa.Array, wanted) -> Iterator[tuple[int, np.ndarray]]:
    for _, found in shingle_sets(column, k):
        if len(found) and wanted(name := _digest(found)):
            yield name, found.tobytes()


def hash_sets(payloads: list[bytes]) -> list[np.ndarray]:
    """The sets that ``_text_sets`` sent."""
    return [np.frombuffer(p, np.uint64) for p in payloads]


def linked(sets: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(i, j) of all similar pairs between the rows in ``left`` and in ``right``, by exact intersections."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = np.zeros((len(sets), len(sets)), np.float32)
    # n-grams of a few sets by listing their pairs, the others by products of 0/1 blocks
    rare = (df[token] > 1) & (df[token] <= 16)
    order = np.lexsort((row[rare], token[rare]))
    t, r = token[rare][order], row[rare][order]
    for step in range(1, 16):
        near = np.flatnonzero(t[step:] == t[:-step])
        if not len(near):
            break
        pair, times = np.unique(r[near] * len(sets) + r[near + step], return_counts=True)
        both.ravel()[pair] += times
    frequent = np.flatnonzero(df > 16)
    place = np.full(len(df), -1)
    place[frequent] = np.arange(len(frequent))
    own = place[token] >= 0
    column, r = place[token[own]], row[own]
    order = np.argsort(column, kind="stable")
    column, r = column[order], r[order]
    for start in range(0, len(frequent), 2048):
        lo, hi = np.searchsorted(column, (start, start + 2048))
        block = np.zeros((len(sets), min(2048, len(frequent) - start)), np.float32)
        block[r[lo:hi], column[lo:hi] - start] = 1
        both += np.triu(block @ block.T, 1)
    i, j = np.nonzero(both)
    shared = both[i, j].astype(np.int64)
    ok = 100 * shared >= percent * (sizes[i] + sizes[j] - shared)
    ok &= left[i] & right[j] | left[j] & right[i]
    return np.stack([i[ok], j[ok]], 1)


def _spanning(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Star edges that join the same rows as the pairs do."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(find(i), i) for i in range(n) if find(i) != i]


def _verify(percent: int, decode, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each group of candidates, from rows sorted by (group, low, high, class)."""

    def out(rows: list[tuple]) -> pa.RecordBatch | None:
        names, sets, block = [r[3] for r in rows], decode([r[4] for r in rows]), np.array([r[5] for r in rows])
        edges = _spanning(linked(sets, percent, block == rows[0][1], block == rows[0][2]), len(rows))
        return _batch({"a": np.array([names[i] for i, _ in edges]), "b": np.array([names[j] for _, j in edges])}) if edges else None

    waiting: list[tuple] = []
    for b in batches:  # a class may come once from each partition of the texts
        for row in zip(*(b.column(c).to_pylist() for c in ("group", "low", "high", "class", "found", "block"))):
            if waiting and waiting[0][:3] != row[:3]:
                if (got := out(waiting)) is not None:
                    yield got
                waiting = []
            if not waiting or waiting[-1][3] != row[3]:
                waiting.append(row)
    if waiting and (got := out(waiting)) is not None:
        yield got


def verified_components(met: DataFrame, sizes: DataFrame, texts: DataFrame, sets_of, percent: int, decode=hash_sets) -> DataFrame:
    """(class, root) of every class that is truly linked to another.

    ``met`` has candidate edges (a, b), ``sizes`` (class, n), and ``sets_of(text column, wanted)`` gives (class, bytes)
    from ``texts`` (text) for the classes that ``wanted`` lets through. ``decode`` makes sorted distinct hashes of such bytes.
    """
    spark = met.sparkSession
    candidates = components(met).select(F.col("node").alias("class"), F.col("component").alias("group"))
    candidates = cut_lineage(candidates.join(sizes, "class"))
    have = np.zeros(BITS, bool)
    have[[r[0] for r in candidates.select(F.pmod("class", F.lit(BITS))).distinct().collect()]] = True  # BITS rows at most
    bits = spark.sparkContext.broadcast(have)
    blocks = cut_lineage(candidates.groupBy("group").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_CLASSES)).cast("int").alias("blocks")).where("blocks > 1"))
    placed = candidates.join(blocks, "group", "left").fillna(1, ["blocks"]).select("class", "group", "blocks")
    found = texts.mapInArrow(partial(_wanted, sets_of, bits), "class long, found binary")
    meets = (
        found.join(bounded_broadcast(cut_lineage(placed), PLACED), "class")
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "found", "block")
    )
    key = ["group", "low", "high"]
    links = meets.repartition(*key).sortWithinPartitions(*key, "class").mapInArrow(partial(_verify, percent, decode), "a long, b long")
    return components(links).select(F.col("node").alias("class"), F.col("component").alias("root"))


def similar_groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of (doc_id, text).

    Words are runs of anything but ASCII white space, with A-Z lower-cased. A set holds a text's distinct runs of ``k`` words, or with
    fewer words the whole sequence; null, empty and blank texts have none and link with nothing. Texts link when
    100 * intersection >= percent * union. The component is the smallest doc_id reachable by links. A row with a null
    doc_id takes part and is never named; its component is null if no other row is in it. Rows of a repeated doc_id
    count as rows of their own. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    first = cut_lineage(texts.mapInArrow(partial(_sets, k), "doc_id long, n_shingles long, class long, strip int, counts binary"))
    sets = first.where("strip is null").select("doc_id", "n_shingles", "class")
    counts = np.zeros(SKETCH, np.int32)
    strips = first.where("strip is not null").select("strip", "counts").repartition("strip").mapInArrow(_strip_sums, "strip int, counts binary")
    for r in strips.collect():  # SKETCH / STRIP rows
        counts[r["strip"] * STRIP : (r["strip"] + 1) * STRIP] = np.frombuffer(r["counts"], np.int32)
    sketch = spark.sparkContext.broadcast(counts)
    prefixes = texts.select("text").mapInArrow(partial(_prefixes, k, percent, sketch), "token long, n int, late boolean, class long")
    met = prefixes.repartition("token").sortWithinPartitions("token", "n", "late", "class").mapInArrow(partial(_chains, percent), "a long, b long, times long")
    met = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("times").alias("times")).where(F.col("times") >= MEETS).select("a", "b")
    sizes = sets.where("class is not null").groupBy("class").agg(F.max("n_shingles").alias("n"))
    joined = verified_components(met, sizes, texts.select("text"), partial(_text_sets, k), percent)
    # classes of several rows, and classes linked to others, learn the smallest doc_id; any other row is alone
    classes = sets.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.join(joined, "class", "left").where("copies > 1 or root is not null").withColumn("root", F.coalesce("root", "class")))
    roots = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut_lineage(classes.join(cut_lineage(roots), "root").select(F.col("class").alias("named"), "component_id"))
    return sets.join(named, F.col("class") == F.col("named"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("named").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op9_rare_first_join(spark, folder: str) -> DataFrame:
    return similar_groups(table(spark, folder, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, len(s)::BIGINT AS n, s FROM g),
r AS (SELECT n, hash(s_all) AS h, min(doc_id) AS rep, list(doc_id) AS ids FROM (SELECT doc_id, n, list_sort(s) AS s_all FROM n WHERE n > 0) GROUP BY n, s_all),
t AS (SELECT r.rep, r.n, unnest(n.s) AS token FROM r JOIN n ON n.doc_id = r.rep),
f AS (SELECT token FROM t GROUP BY token HAVING count(*) > 1),
u AS (SELECT t.* FROM t JOIN f USING (token)),
p AS (
  SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.token = b.token AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), c AS (
  SELECT rep AS x, rep AS y FROM r
  UNION
  SELECT p.b AS x, c.y FROM c JOIN p ON c.x = p.a
), m AS (SELECT x, min(y) AS component_id FROM c GROUP BY x),
o AS (SELECT unnest(r.ids) AS doc_id, m.component_id FROM r JOIN m ON m.x = r.rep)
SELECT n.doc_id, n.n AS n_shingles, coalesce(o.component_id, n.doc_id) AS component_id FROM n LEFT JOIN o USING (doc_id)
"""
