"""Benchmark decontamination by SimHash over item-sized windows (DataFrame operations only).

Windows of a text have the length of the benchmark item that they are held against. A window that is similar enough shares most
shingles with its item, so all starts are taken from which enough places of the text hold a shingle of an item of that length;
texts without one have no window. Starts before the least place where a shingle of the text and of an item fall on each
other, or after the greatest, are left out: moving the window there loses no common shingle. A window's SimHash takes the majority of its shingles' hash bits, each as often as it
occurs. Fingerprints of windows and items of one length are joined on equal blocks: with one block more than the radius,
any two fingerprints within the radius agree in a block, so the join finds all of them, and a pair counts only in the first
block that agrees. The weighted Jaccard similarity of both shingle bags then decides exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opspark.llm.common import WORD, table
from opspark.session import bounded_broadcast, cut_lineage

#: Words in a shingle; an item or window with fewer words is one shingle.
SHINGLE = 5

#: Similarity in percent from which a window is contaminated.
PERCENT = 80

#: Hamming radius. Bags with a similarity of 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 19

_BLOCKS = RADIUS + 1
#: First bit and width of each block; they cover all 64 bits.
_CUTS = [(64 * b // _BLOCKS, 64 * (b + 1) // _BLOCKS - 64 * b // _BLOCKS) for b in range(_BLOCKS)]


def bound(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often it is named (also inside nested functions)."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words; empty for null."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def shingles(hashes: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words; empty if there are fewer words."""
    run = lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(width)))
    return F.when(F.size(hashes) >= width, F.transform(F.sequence(F.lit(0), F.size(hashes) - width), run)).otherwise(F.array().cast("array<long>"))


def simhash(bag: Column) -> Column:
    """64 bits: each set where more than half of the hashes have it.

    Up to 65 535 hashes four counters of 16 bits share a long; beyond, every bit has a counter of its own.
    """
    lanes, half = F.lit(0x0001000100010001), F.size(bag)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    none = F.lit(0).cast("long")
    total = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.aggregate(
        bag, none, lambda a, h: a + F.call_function("shiftrightunsigned", h, k).bitwiseAND(lanes)))
    packed = F.transform(total, lambda s, k: sum((
        F.when(F.shiftrightunsigned(s, 16 * j).bitwiseAND(F.lit(0xFFFF)) * 2 > half, bit(k + 16 * j)).otherwise(none)
        for j in range(1, 4)), F.when(s.bitwiseAND(F.lit(0xFFFF)) * 2 > half, bit(k)).otherwise(none)))
    apart = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.when(F.aggregate(
        bag, none, lambda a, h: a + F.call_function("shiftrightunsigned", h, k).bitwiseAND(F.lit(1).cast("long"))) * 2 > half, bit(k)).otherwise(none))
    return F.aggregate(F.when(half < 1 << 16, packed).otherwise(apart), none, lambda a, b: a.bitwiseOR(b))


def numbered(bag: Column) -> Column:
    """Each hash joined with how often it came before, so that bags can be met like sets."""
    return F.transform(bag, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(bag, F.lit(1), i), lambda x: x == h))))


def _block(fingerprint: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fingerprint, cut[0]).bitwiseAND(F.lit((1 << cut[1]) - 1))


def _blocks(fingerprint: Column) -> Column:
    return F.array(*(_block(fingerprint, c) for c in _CUTS))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, bag, print) of each item with words; ``bag`` holds its shingles in order."""
    def bag(hashes: Column) -> Column:
        whole = shingles(hashes, SHINGLE)
        for width in range(1, SHINGLE):
            whole = F.when(F.size(hashes) == width, shingles(hashes, width)).otherwise(whole)
        return F.struct(F.size(hashes).alias("words"), whole.alias("bag"))

    items = benchmark.select("item_id", bound(word_hashes(benchmark["text"]), bag).alias("item")).select("item_id", "item.words", "item.bag").where("words > 0")
    # written down, so that the fingerprint is not worked out again wherever it is named
    return cut_lineage(items.withColumn("print", bound(F.col("bag"), simhash)))


def _starts(many: Column, percent: int) -> Column:
    """Starts from low to high of the windows of ``many`` shingles in which enough of the sorted ``places`` lie."""
    places = F.col("places")
    need = F.greatest(F.lit(1), F.ceil((F.least(many, F.col("n")) + many) * percent / (100 + percent) - 1e-9).cast("int"))

    def run(i: Column) -> Column:
        # place i is the first one in the window, and the last one needed still lies in it
        first = F.greatest(F.col("low"), F.coalesce(F.get(places, i - 1) + 1, F.lit(0)), F.get(places, i + need - 1) - many + 1)
        last = F.least(F.col("high"), F.get(places, i))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(places) >= need, F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - need), run))).otherwise(F.array().cast("array<int>"))


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, start, similarity): the best window of each text for each item that it holds.

    ``start`` is the window's first word, from 0; of equal similarities the first window counts. Null, empty and blank texts
    and items match nothing. A text shorter than an item is one window. Rows with one doc_id count as one document, null ids
    too. Repeated items are items of their own.
    """
    items = item_windows(benchmark)
    widths = [r[0] for r in items.select(F.least("words", F.lit(SHINGLE))).distinct().collect()]  # SHINGLE values at most
    anchors = items.select("words", F.posexplode("bag").alias("at", "shingle")).distinct()
    anchors = bounded_broadcast(anchors.select("shingle", F.col("words").alias("size"), "at"))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    windows = None
    for width in sorted(widths):
        bag = bound(word_hashes(F.col("text")), lambda h: shingles(h, width))
        own = keyed.select("row_key", bag.alias("bag")).select("row_key", F.size("bag").alias("n"), F.posexplode("bag").alias("place", "found"))
        start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("at"), F.col("n") + width - 1 - F.col("size")))
        met = own.join(anchors.where(F.least("size", F.lit(SHINGLE)) == width), F.col("found") == F.col("shingle"))
        met = met.withColumn("start", start).groupBy("row_key", "size").agg(
            F.max("n").alias("n"), F.min("start").alias("low"), F.max("start").alias("high"), F.sort_array(F.collect_set("place")).alias("places"))
        starts = met.select(F.col("row_key").alias("of"), "size", _starts(F.col("size") - width + 1, percent).alias("starts"))
        starts = bounded_broadcast(cut_lineage(starts.where(F.size("starts") > 0)))
        met = keyed.join(starts, F.col("row_key") == F.col("of")).select("doc_id", "size", bag.alias("bag"), "starts")
        met = met.select("doc_id", "size", "bag", F.explode("starts").alias("start"))
        met = met.select("doc_id", "size", "start", F.slice("bag", F.col("start") + 1, F.col("size") - width + 1).alias("window"))
        windows = met if windows is None else windows.unionByName(met)
    if windows is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)['item_id']}, start int, similarity double")
    # one row a window, also where rows repeat
    windows = windows.distinct()
    windows = cut_lineage(windows.withColumn("window_print", bound(F.col("window"), simhash)))
    keys = items.select("item_id", "words", "bag", "print", F.posexplode(_blocks(F.col("print"))).alias("block", "value"))
    looked = windows.select("*", F.posexplode(_blocks(F.col("window_print"))).alias("own_block", "own_value"))
    pairs = looked.join(
        bounded_broadcast(keys), (F.col("size") == F.col("words")) & (F.col("own_block") == F.col("block")) & (F.col("own_value") == F.col("value")))
    apart = F.col("window_print").bitwiseXOR(F.col("print"))
    first = F.array_position(F.transform(_blocks(apart), lambda v: v == 0), F.lit(True)) - 1
    shared = F.size(F.array_intersect(numbered(F.col("window")), numbered(F.col("bag"))))
    return (
        pairs.where((F.bit_count(apart) <= RADIUS) & (first == F.col("block")))
        .withColumn("shared", shared)
        .withColumn("all", F.size("window") + F.size("bag") - F.col("shared"))
        .where(F.col("shared") * 100 >= F.col("all") * percent)
        .groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("shared") / F.col("all")).alias("similarity"), (-F.col("start")).alias("start"))).alias("best"))
        .select("doc_id", "item_id", (-F.col("best.start")).cast("int").alias("start"), F.col("best.similarity").alias("similarity"))
    )


def op8_simhash_windows(spark, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
