"""Groups of spelling variants: words one letter apart, by a relational trie frontier.

The trie is a table of edges (side, node, letter): a node is a prefix, and letters go on from it. It is built twice,
over the words and over the words read backwards, because an edit then always stands behind half of the word: an edit at or behind
the middle leaves the first half as it is, one before the middle the second half. So no state starts at the root, where all words meet.

1. States (word, place, node, edits) without an edit walk down their own word. Behind the middle each may use its edit: replace its
   letter by another edge of its node, or skip its letter. (Inserting is skipping, seen from the other word.) Edges tell what goes on
   from their child, so an edit is made only where the letter behind it goes on.
2. A state that has used its edit goes on along the edges that its word names, level by level: each round joins the frontier
   with the edge table, and states without an edge end. A round walks one level at first and twice as many each time, as a
   state then has one path left.
3. A state at the end of its word whose node is a word has found a neighbour.

A node that many words share is split: its states and its edges get salts, as many as its words need. A node has at most as many edges as the
alphabet has letters, so no join gives more than that many rows per state.

A round of its own per level would be as many rounds as a word has letters, so words of ``LONG`` letters and more meet another way, which
is exact as well: on the hash of the word without one of its letters, checked on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opspark.llm.common import table
from opspark.session import bounded_broadcast, cut_lineage

#: Letters of a run of letters.
LETTERS = r"A-Za-zÀ-ÿ"

#: Fewest letters and occurrences of a word, and how many times more frequent its form is.
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10

#: Words from this length on do not go through the trie.
LONG = 33

#: Words under a node from which on its states are salted, each salt having about so many.
HOT = 20_000

#: The edge that a word's end is.
END = "$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(doc_id, run) for each maximal run of at least ``least`` letters of the whole texts, A-Z in lower case."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def counted_words(words: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    kept = words.where(F.char_length("word") >= least)
    return kept.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _both_ways(words: DataFrame) -> DataFrame:
    """(side, text): each word as it is and read backwards."""
    return words.select(F.explode(F.array(
        F.struct(F.lit(False).alias("side"), F.col("word").alias("text")), F.struct(F.lit(True).alias("side"), F.reverse("word").alias("text")))).alias("s")).select("s.*")


def _letter(text: Column, place: Column) -> Column:
    """The letter at a place, ``END`` behind the last one."""
    return F.when(place < F.char_length(text), F.substring(text, place + 1, F.lit(1))).otherwise(END)


def _edges(words: DataFrame) -> DataFrame:
    """(side, node, letter, below): the edges behind the middle of each word, one letter of slack included, and the words below each.

    An edge ``END`` stands where a word ends.
    """
    text, depth = F.col("text"), F.col("depth")
    # a word that is one letter longer than its neighbour has its middle at most one letter further on
    first = F.floor((F.char_length(text) - 1) / 2).cast("int")
    deep = _both_ways(words).withColumn("depth", F.explode(F.sequence(first, F.char_length(text))))
    return deep.groupBy("side", F.substring(text, F.lit(1), depth).alias("node"), _letter(text, depth).alias("letter")).agg(F.count("*").alias("below"))


def _own_path(words: DataFrame) -> DataFrame:
    """States (side, text, place, node) without an edit, from the middle on: the half of the word, counted from the side's end."""
    text = F.col("text")
    half = F.floor(F.char_length(text) / 2).cast("int")
    low, high = F.when(F.col("side"), F.char_length(text) - half).otherwise(half), F.char_length(text) - 1
    walk = _both_ways(words).where(low <= high).withColumn("place", F.explode(F.sequence(low, high)))
    return walk.withColumn("node", F.substring(text, F.lit(1), F.col("place")))


def trie_neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near), each once in either direction, of words of fewer than ``LONG`` letters."""
    short = words.select("word").where(F.char_length("word") < LONG)
    edges = cut_lineage(_edges(short))
    prefixes = edges.where(F.col("letter") != END).select("side", F.concat("node", "letter").alias("node"))

    # nodes with a choice of edges; each edge tells the letters that go on from its child
    letters = edges.groupBy("side", "node").agg(F.array_join(F.collect_set("letter"), "").alias("letters"), F.sum("below").alias("words"))
    letters = cut_lineage(letters)
    forks = letters.where(F.char_length("letters") > 1)
    children = forks.select("side", "node", "words", F.explode(F.split("letters", "")).alias("letter")).where(F.col("letter") != "")
    after = letters.select(F.col("side").alias("_side"), F.col("node").alias("_child"), F.col("letters").alias("after"))
    known = children.join(after, (F.col("side") == F.col("_side")) & (F.concat("node", "letter") == F.col("_child")), "left")
    choices = known.groupBy("side", "node").agg(F.first("words").alias("words"), F.collect_list(F.struct("letter", F.coalesce("after", F.lit("")).alias("after"))).alias("choices"))
    # nodes with many words are salted
    salts = F.ceil(F.col("words") / HOT).cast("int")
    fan = bounded_broadcast(cut_lineage(letters.where(F.col("words") > HOT).select("side", "node", salts.alias("salts"))))
    choices = choices.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("words")
    own = _own_path(short).join(fan, ["side", "node"], "left")
    own = own.withColumn("salt", F.pmod(F.xxhash64("text"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")

    # the edit, and with it the letter behind it: another edge that goes on with that letter, or that letter in place of the own one. Of equal
    # letters in a row only the last is skipped, as skipping any of them gives the same word
    here, behind = _letter(F.col("text"), F.col("place")), _letter(F.col("text"), F.col("place") + 1)
    options = own.join(choices, ["side", "node", "salt"]).withColumn("c", F.explode("choices")).select(
        "side", "text", "place", "node", "c.letter", "c.after", here.alias("here"), behind.alias("behind"))
    replaces = (F.col("letter") != F.col("here")) & (F.col("letter") != END) & F.contains("after", "behind")
    skips = (F.col("letter") == F.col("behind")) & (F.col("behind") != F.col("here"))
    reached = F.when(F.col("behind") == END, "").otherwise(F.col("behind"))
    options = options.where(replaces | skips)
    nodes = F.array(F.when(replaces, F.concat("node", "letter", reached)), F.when(skips, F.concat("node", reached)))
    frontier = options.select("side", "text", (F.col("place") + 1 + F.char_length(reached)).alias("place"), F.explode(nodes).alias("node")).where("node is not null")
    frontier = cut_lineage(frontier)

    ended = []
    levels = 1
    while True:
        left = F.char_length("text") - F.col("place")
        ended.append(frontier.where(left == 0))
        step = F.least(F.lit(levels), left)
        going = frontier.where(left > 0).select(
            "side", "text", (F.col("place") + step).alias("place"), F.concat("node", F.substring(F.col("text"), F.col("place") + 1, step)).alias("node"))
        frontier = cut_lineage(going.join(prefixes, ["side", "node"], "left_semi"))
        if frontier.isEmpty():
            break
        levels *= 2
    done = ended[0]
    for more in ended[1:]:
        done = done.unionByName(more)
    pairs = done.select(*(F.when(F.col("side"), F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("text", "word"), ("node", "near"))))
    met = pairs.join(short.select(F.col("word").alias("near")), "near", "left_semi")
    return met.unionByName(met.select(F.col("near").alias("word"), F.col("word").alias("near"))).select("word", "near").distinct()


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(letters, place, hash, name) of each word without one letter, and of the word itself with place -1; name is its MD5."""
    base = 0x9E3779B97F4A7C15 | 1
    for b in batches:
        for word in b.column("word").to_pylist():
            code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
            code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            n = len(code)
            power = np.full(n + 1, base, np.uint64)
            power[0] = 1
            power = np.cumprod(power, dtype=np.uint64)
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[:n], dtype=np.uint64)])
            # the letters behind the gap move down by one place
            behind = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code[1:] * power[: n - 1], dtype=np.uint64)])
            values = np.append(upto[:n] + (behind[-1] - behind), upto[n]).view(np.int64)
            place = np.append(np.arange(n), -1)
            name = md5(word.encode()).digest()
            for start in range(0, n + 1, 10_000):
                part = slice(start, min(start + 10_000, n + 1))
                many = part.stop - start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(many, n)), pa.array(place[part]), pa.array(values[part]), pa.array([name] * many, pa.binary())],
                    names=["letters", "place", "hash", "name"])


def long_neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near), each once in either direction, where both words have ``LONG - 1`` letters or more.

    Words travel as their MD5 while they meet; the words themselves are joined to what met, and checked.
    """
    long = words.select("word").where(F.char_length("word") >= LONG - 1)
    gaps = long.mapInArrow(_gaps, "letters long, place long, hash long, name binary")
    gaps = cut_lineage(gaps)
    cut, whole = gaps.where("place >= 0"), gaps.where("place < 0")
    # at most one word per letter of the alphabet shares what is left of a word without one letter at one place
    other = cut.select("letters", "place", "hash", F.col("name").alias("other"))
    same = cut.join(other, ["letters", "place", "hash"]).where("name < other").select("name", "other")
    shorter = whole.select((F.col("letters") + 1).alias("letters"), "hash", F.col("name").alias("other"))
    less = cut.select("letters", "hash", "name").join(shorter, ["letters", "hash"]).select("name", "other")
    met = same.unionByName(less).distinct()
    named = long.select(F.unhex(F.md5("word")).alias("name"), "word")
    met = met.join(named, "name").join(named.select(F.col("name").alias("other"), F.col("word").alias("near")), "other").select("word", "near")
    met = met.where(one_apart(F.col("word"), F.col("near")))
    return met.unionByName(met.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def one_apart(a: Column, b: Column) -> Column:
    """Whether two words differ by exactly one letter inserted, deleted or replaced; the bound keeps the work linear in their length."""
    return F.levenshtein(a, b, 1) == 1


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near) of words exactly one letter apart, each in both directions once."""
    short = trie_neighbours(words)
    if words.where(F.char_length("word") >= LONG).isEmpty():
        return short
    return short.unionByName(long_neighbours(words)).distinct()


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of counted words (word, n).

    A form is ``times`` as frequent as its word, so following forms ends after a few steps; the rounds double the steps.
    """
    near = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = near.groupBy(F.col("word").alias("of")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, F.col("word") == F.col("of"), "left")
    strong = -F.col("best.less") >= times * F.col("n")
    result = cut_lineage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n")))
    step = result.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = cut_lineage(step.join(onward, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return result.join(step, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def thinned(runs: DataFrame) -> DataFrame:
    """``word``: the run, or the run without one letter where its digest with the document says so."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark, folder: str) -> DataFrame:
    """Words of all documents with their variants' common form and root."""
    words = cut_lineage(counted_words(thinned(letter_runs(table(spark, folder, "documents")))))
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
