"""Periodic runs of words: seed and extend along diagonals.

A run of period q holds at least ``max(least, repeats * q)`` words, so the text and the text moved on by q words agree there on
``max(least - q, (repeats - 1) * q)`` words: the overlap. Lags are taken in classes [2^j, 2^(j+1)); the least overlap of a class is
the length k of its seeds.

1. The k-grams of a document are indexed: equal ones get one number. A gram that stands once in its document goes, with all
   longer ones over it; longer grams are numbered by the numbers of two shorter ones, so later classes look at ever fewer places.
2. Occurrence pairs of a gram in the same document, each with the next one, whose lag is in the class are the seeds. As k is no
   less than the lag, a run of smallest period q gives a seed of lag q at each place of its overlap: a nearer occurrence
   would give the run a smaller period. So the pairs with the next occurrence are all that is needed, and they are no more than the words.
3. Seeds are taken in order of lag and place. The place up to which a lag is covered moves on with its seeds; only a seed beyond it starts
   an extension, and that ends where the lag's cover ends.

Texts of a batch are handled together as arrays; work is words times the logarithm of the longest lag, on repeated grams only.
Words stand as 64-bit hashes: two different grams of a document are taken for one with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from opspark.llm.common import WORD, mix, small_batches, table, texts_of

#: Words that a run has at least, and times that its period is repeated at least.
LEAST = 6
REPEATS = 4

RUN = "struct<start: long, length: long, period: long>"


def seed_lengths(longest: int, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int]]:
    """(k, smallest lag) of each class of lags that a document of ``longest`` words can hold, in order of k."""
    out, low = [], 1
    while max(least, repeats * low) <= longest:
        lags = range(low, min(2 * low, max(low + 1, least + 1)))
        out.append((min(max(least - q, (repeats - 1) * q) for q in lags), low))
        low *= 2
    return sorted(out)


def _grams(ids: np.ndarray, document: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k-grams that repeat in their document, and their numbers."""
    at = np.arange(len(ids))
    at = at[at + k <= ends]
    if not len(at):
        return at, at
    out = mix(document[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for j in range(k):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + ids[at + j])
    ordered = np.sort(out)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return at[:0], at[:0]
    place = np.minimum(np.searchsorted(twice, out), len(twice) - 1)
    met = twice[place] == out
    return at[met], place[met]


def _longer(at: np.ndarray, number: np.ndarray, step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the repeated grams that are ``step`` words longer than the given ones."""
    whole = np.full(size + step, -1, np.int64)
    whole[at] = number
    second = whole[at + step]
    at, first, second = at[second >= 0], number[second >= 0], second[second >= 0]
    _, number, many = np.unique(first * (size + 1) + second, return_inverse=True, return_counts=True)
    keep = many[number] > 1
    return at[keep], number[keep]


def find_runs(ids: np.ndarray, document: np.ndarray, ends: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, length, period) of all runs, ordered by start and period.

    ``ids`` are the words of some documents one after the other, ``document`` the number of the document of each word and
    ``ends`` the place after its last word. Starts count over all words.
    """
    if repeats < 3:
        raise ValueError("runs of fewer than three repeats need longer seeds")
    found = []
    longest = int(np.bincount(document).max()) if len(ids) else 0
    k = 0
    for want, low in seed_lengths(longest, least, repeats):
        if not k:
            at, number = _grams(ids, document, ends, want)
            k = want
        while k < want and len(at):
            step = min(k, want - k)
            at, number = _longer(at, number, step, len(ids))
            k += step
        if not len(at):
            break
        order = np.lexsort((at, number))
        place, name = at[order], number[order]
        lag = place[1:] - place[:-1]
        seed = (name[1:] == name[:-1]) & (lag >= low) & (lag < 2 * low)
        place, lag = place[:-1][seed], lag[seed]
        if not len(place):
            continue
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # a seed right after the former one of its lag is covered already; any other starts an extension
        fresh = np.ones(len(place), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        period = lag[first]
        length = place[last] + k + period - place[first]
        long = length >= np.maximum(least, repeats * period)
        found.append(np.stack([place[first], length, period], 1)[long])
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _batch(keep: Sequence[str], text: str, least: int, repeats: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = texts_of(b.column(text))
        raw = data.tobytes()
        split = [raw[offsets[i] : offsets[i + 1]].split() for i in range(b.num_rows)]  # at exactly the six ASCII spaces
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(counts)
        words = [w for row in split for w in row]
        ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        document = np.repeat(np.arange(len(split)), counts)
        runs = find_runs(ids, document, ends[document], least, repeats)
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        stays = np.cumsum(drop)[:-1] == 0
        owner = document[runs[:, 0]]
        touched = set(owner.tolist())
        first = ends - counts
        collapsed = [
            b" ".join(compress(row, stays[first[i] : ends[i]].tolist()) if i in touched else row) for i, row in enumerate(split)]
        values = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - first[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(schema.field("runs").type.value_type))
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32)), values)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in keep), pa.array(counts), lists.cast(schema.field("runs").type), pa.array(collapsed, pa.binary()).cast(pa.string())],
            names=[*keep, "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """The columns ``keep`` of each row, with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) by start, then period. ``collapsed`` is the text's words joined by one space, without
    the words that a run holds after its first period. A null or empty text has no words, no runs and an empty
    collapsed text. Rows stand for themselves, however often they are repeated and whatever their other columns hold;
    columns that are not kept may have any name. A text is handled whole by one task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(docs.sparkSession)
    kept = [docs.schema[c] for c in keep]
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    narrow = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    return narrow.mapInArrow(partial(_batch, list(keep), "_text", least, repeats, to_arrow_schema(schema)), schema)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a periodic tail in one of ten documents, told by the digest of doc_id; a null doc_id plants nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    base = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False)).alias("plant"))
    cut = base.withColumn("words", F.when(F.col("plant"), words)).withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest)), " ")
    return cut.select("doc_id", F.when(F.col("plant") & (F.col("n") > 0), text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, folder: str) -> DataFrame:
    """The longest run and digests of all runs and of the collapsed text, per document."""
    found = periodic_runs(planted(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    period = -F.col("best.period")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        period.alias("period"), F.floor(1000 * F.col("best.length") / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
