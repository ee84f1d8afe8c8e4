"""Operators on documents: brute force on whole small tables, and odd cases."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from opspark.llm import decontaminate, lines, mixing, ngram_join, sharding, tokens, toxicity
from tests.conftest import SF
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd_documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.DOCS)


# --- token counts -----------------------------------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, docs, odd, empty):
    text = tokens.vocabulary_text()
    library = Tokenizer.from_str(text)
    hard = ["<|endoftext|> a<|startoftext|>b", "<|EndOfText|>", "é É Σας ΑΣ İ", "a\x1cb\x85c​d﻿", "don't DON'T 12 ९ 3½", "\r\n", "漢字かな", "ẛ̣ ﬁ ..."]
    for df in (docs, odd, spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")):
        for r in df.select("text", tokens.count_tokens(spark, F.col("text"), text).alias("n")).collect():
            assert r.n == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert empty.select(tokens.count_tokens(spark, F.col("text"), text)).collect() == []


def test_whole_tokens_are_single_tokens():
    text = tokens.vocabulary_text()
    whole = sorted(tokens.whole_tokens(text))
    library = Tokenizer.from_str(text)
    assert len(whole) > 20_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole[::50], add_special_tokens=False))


# --- lines ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_lines_against_all_pairs(request, name):
    df = request.getfixturevalue(name)
    df = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {(r.doc_id, r.line): r.kept for r in lines.fuzzy_lines(df).collect()}
    assert got == brute.kept_lines([(r.doc_id, r.text) for r in df.collect()])


def test_lines_odd_rows(odd, empty):
    rows = lines.fuzzy_lines(odd).collect()
    assert all(r.kept for r in rows if r.doc_id in (4, 5, 6))
    assert not any(r.kept for r in rows if r.doc_id is None and r["class"] is not None)
    assert sum(r.kept for r in rows if r.doc_id == 2) == 0
    assert lines.fuzzy_lines(empty).collect() == []
    once = odd.where("doc_id < 100 and doc_id <> 2")
    texts = {r.doc_id: r.text for r in lines.kept_text(once, lines.fuzzy_lines(once)).collect()}
    assert texts[1] == brute.PROSE and texts[3] == "" and texts[5] is None


def test_minhash_recall():
    import numpy as np

    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    met = 0
    for _ in range(200):
        a = rng.choice(letters, 200)
        b = a.copy()
        b[rng.choice(200, 4, replace=False)] = "é"
        sets = lines.line_sets(["x" + "".join(v) + "x" for v in (a, b)])
        got = [set(r) for r in _bands_of(["x" + "".join(a) + "x", "x" + "".join(b) + "x"])]
        assert len(np.intersect1d(*sets)) / len(np.union1d(*sets)) >= 0.8
        met += bool(got[0] & got[1])
    assert met >= 190


def test_one_typo_in_a_line_of_sixty_characters(spark):
    line = "sphinx of black quartz judge my vow and pack five dozen jugs"
    assert len(line) == 60
    df = spark.createDataFrame([(1, line), (2, line.replace("judge", "jadge"))], "doc_id long, text string")
    # 51 of 61 shingles of five characters are shared
    assert {r.doc_id: r.kept for r in lines.fuzzy_lines(df).collect()} == {1: True, 2: False}


def test_lines_of_null_and_repeated_ids_stay_apart(spark, folder):
    a, b = "a line that stands in two of the texts given here", "another line, which stands in one of them"
    rows = [(1, a), (None, f"{b}\n{a}"), (None, f"x\ny\n{a}"), (3, "left"), (3, f"{a}\nright\n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = [(r.doc_id, r.n_lines, r.n_kept, tuple(r.dropped)) for r in lines.op2_fuzzy_lines(spark, folder).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1, ()), (None, 2, 1, (1,)), (None, 3, 2, (2,)), (3, 1, 1, ()), (3, 3, 2, (0,))], key=str)


def test_one_line_stays_where_places_tie(spark):
    df = spark.createDataFrame([(5, "one line that is the same in both rows"), (5, "one line that is the same in both rows"), (5, "one line that is the same in both rows!")], "doc_id long, text string")
    assert sum(r.kept for r in lines.fuzzy_lines(df).collect()) == 1


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK_LINES", 40)
    base = "".join(f"{i:03d}-" for i in range(60))
    rows = [(i, base[: 4 * (i % 50)] + f"#{i}#" + base[4 * (i % 50) + 5 :]) for i in range(220)] + [(900 + i, f"an other line {i}") for i in range(30)]
    got = {(r.doc_id, r.line): r.kept for r in lines.fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.kept_lines(rows)


def test_bands_met_wherever_batches_end():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    rows = sorted((int(b), int(c)) for b, c in zip(rng.integers(0, 60, 150), rng.integers(0, 9, 150)))
    held = {}
    for band, name in rows:
        held.setdefault(band, set()).add(name)
    want = sorted((b, c) for b, names in held.items() if len(names) > 1 for c in names)
    for size in (1, 2, 3, 7, 150):
        cut = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + size])], names=["band", "class"]) for i in range(0, 150, size)]
        got = [(r["band"], r["class"]) for b in lines._met(iter(cut)) for r in b.to_pylist()]
        assert got == want


def test_small_groups_at_once_and_one_by_one():
    import numpy as np

    rng = np.random.default_rng(9)
    texts, group = [], []
    for g in range(60):
        base = "".join(rng.choice(list("abcdef "), int(rng.integers(1, 90)))).strip() or "x"
        for _ in range(int(rng.integers(1, 7))):
            at = int(rng.integers(0, len(base)))
            texts.append(base[:at] + "é" * int(rng.integers(0, 2)) + base[at:])
            group.append(g)
    group = np.array(group)
    got = {tuple(p) for p in lines.linked_inside(texts, group, 80).tolist()}
    sets = [set(s.tolist()) for s in lines.line_sets(texts)]
    assert got == {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
                   if group[i] == group[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def _bands_of(texts):
    import pyarrow as pa

    out = {}
    for b in lines._bands(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])):
        for band, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out.setdefault(name, []).append(band)
    return list(out.values())


# --- sharding ---------------------------------------------------------------------------------------------------------


def _sound(rows, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(shards))
    return sizes


def test_shards_are_even_and_slots_gapless(spark, docs, odd, empty):
    for df in (docs.select("doc_id"), odd, brute.odd_documents(spark, "clashing")):
        rows = sharding.assign(df, ["doc_id"], 40).collect()
        sizes = _sound(rows, 40)
        assert len(rows) == df.count() and max(sizes) - min(sizes) <= 1
    assert sharding.assign(empty, ["doc_id"]).collect() == []


def test_shards_with_room_move_the_least(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    rows = sharding.assign(df, ["doc_id"], 20, 32, slack=0.1).collect()
    sizes = _sound(rows, 20)
    capacity = math.ceil(1.1 * 5000 / 20)
    assert max(sizes) <= capacity
    # a row that moved left a full shard
    assert sum(r.moved for r in rows) < 500 and any(r.moved for r in rows)
    loose = {r.row.doc_id: r.shard for r in sharding.assign(df, ["doc_id"], 20, 32, slack=5.0).collect()}
    assert all(loose[r.row.doc_id] == r.shard for r in rows if not r.moved)
    wanted = [sum(s == k for s in loose.values()) for k in range(20)]
    assert sum(r.moved for r in rows) == sum(max(0, n - capacity) for n in wanted)


# --- mixing -----------------------------------------------------------------------------------------------------------


def test_mix_meets_targets(spark, odd, empty):
    df = brute.odd_documents(spark, "clashing").withColumn("n", mixing.word_count(F.col("text")))
    rows = mixing.mix(df, ["doc_id", "n"], size="n").collect()
    assert len(rows) == df.count()
    total = sum(r.row.n for r in rows)
    by = {}
    for r in rows:
        got = by.setdefault(r.row.source, [0, r.target, r.source_size])
        got[0] += r.taken
        assert r.taken == sum(t.words for t in r.takes) <= 2 * r.row.n
        assert all(0 <= t.position <= 1 for t in r.takes)
    assert all(abs(taken - target) <= 1 and target <= 2 * size for taken, target, size in by.values())
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * total) < 1e-6 * total
    assert mixing.mix(empty.withColumn("n", F.lit(1)), ["doc_id"], size="n").collect() == []


def test_positions_follow_the_schedule(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' ELSE 'c' END AS source", "10L AS size")
    takes = mixing.training_order(mixing.mix(df, ["doc_id"])).collect()
    early = [t for t in takes if t.position < 0.5]
    share = lambda part, s: sum(t.words for t in part if t.row.source == s) / sum(t.words for t in takes if t.row.source == s)
    # the integral to one half of a line from 1.5 to 0.5 is 0.625, of one from 0.5 to 1.5 it is 0.375
    assert abs(share(early, "a") - 0.625) < 0.01 and abs(share(early, "b") - 0.375) < 0.01 and abs(share(early, "c") - 0.5) < 0.01
    assert [t.position for t in takes] == sorted(t.position for t in takes)


# --- n-gram join ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
@pytest.mark.parametrize("name", ["docs", "odd"])
def test_groups_against_all_pairs(request, name, k, percent):
    df = request.getfixturevalue(name)
    got = sorted(map(tuple, ngram_join.similar_groups(df, k, percent).collect()), key=str)
    assert got == sorted(brute.jaccard_groups([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], k, percent), key=str)


def test_groups_of_an_empty_table(empty):
    assert ngram_join.similar_groups(empty).collect() == []


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 40)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(220):
        w = list(base)
        w[i % 60] = f"x{i}"
        rows.append((i, " ".join(w[: 58 + i % 3])))
    got = sorted(map(tuple, ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted(brute.jaccard_groups(rows, 4, 85))


# --- decontamination --------------------------------------------------------------------------------------------------


def test_leaks_against_all_windows(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, items).collect()}
    assert got == brute.leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]) and got


def test_leaks_odd_cases(spark, odd, empty):
    edited = brute.PROSE.split()
    rows = [(1, brute.PROSE), (2, "one two"), (3, None), (4, ""), (5, "!?"), (6, brute.PROSE), (7, " ".join(edited[:-2] + ["new", "end"])), (None, "copy of a line the quick")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    df = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(df, items).collect()}
    assert got == brute.leaks([(r.doc_id, r.text) for r in df.collect()], rows)
    assert decontaminate.contaminated(empty, items).collect() == []
    assert decontaminate.contaminated(odd, items.limit(0)).collect() == []


def test_leaks_between_aligned_starts(spark):
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    held = [f"a{i}" for i in range(40)] + words[13:150] + [f"x{i}" for i in range(24)] + words[150:287] + [f"b{i}" for i in range(40)]
    rows, items = [(1, " ".join(held)), (2, " ".join(["y"] * 9 + swapped + ["z"] * 9))], [(1, " ".join(words))]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute.leaks(rows, items) and set(got) == {(1, 1), (2, 1)}


def test_close_prints_agree_in_a_block():
    assert sum(w for _, w in decontaminate._CUTS) == 64 and len(decontaminate._CUTS) == decontaminate.RADIUS + 1


# --- toxicity ---------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    folder = SF.replace("0.001", "0.1")
    got = toxicity.op10_pu_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted == r.toxic for r in got) / len(got)
    caught = [r.predicted for r in got if r.toxic == 1]
    assert hits > 0.97 and sum(caught) / len(caught) > 0.8
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_odd_cases(spark, odd, empty):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (3, 1, None), (3, 1, 0), (77, 0, 1), (100, 1, 0)], "doc_id long, quality int, toxic int")
    for df, known in ((odd, labels), (odd, labels.limit(0)), (empty, labels)):
        model = toxicity.learn(df, known)
        rows = df.select("text", toxicity.score(spark, F.col("text"), model).alias("score")).collect()
        assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)


# --- pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, folder, docs):
    """Each stage against a plain version of its decision, on its own input."""
    given, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, given, SF).write.parquet(f"{folder}/{name}")
        given = spark.read.parquet(f"{folder}/{name}")
        kept.append(given.collect())
    clean, single, safe, mixed, sharded = kept
    assert all(r.__fields__ == docs.columns for part in kept[:4] for r in part[:1])
    groups = brute.jaccard_groups([(r.doc_id, r.text) for r in clean], 5, 80)
    assert {r.doc_id for r in single} == {c for _, _, c in groups}
    leaked = brute.leaks([(r.doc_id, r.text) for r in single], [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert {r.doc_id for r in safe} == {r.doc_id for r in single} - {d for d, _ in leaked}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in safe}
    taken = sum(len(brute.words(r.text)) for r in mixed)
    assert taken >= 1.5 * sum(len(brute.words(r.text)) for r in safe)
    assert sorted(r.doc_id for r in sharded) == sorted(r.doc_id for r in mixed)
    sizes = _sound(sharded, 40)
    assert max(sizes) - min(sizes) <= 1


def test_pipeline_odd_cases(spark, folder, empty):
    for n, df in enumerate((brute.odd_documents(spark, "clashing"), empty)):
        given = df
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, given, SF).write.parquet(f"{folder}/{n}/{name}")
            given = spark.read.parquet(f"{folder}/{n}/{name}")
            assert given.columns[: len(df.columns)] == df.columns


def test_pipeline_null_and_repeated_ids(spark, folder):
    other = "a clean text of quite different words that nothing else in this small table resembles at all"
    rows = [(None, brute.PROSE), (None, brute.PROSE), (2, brute.PROSE), (2, brute.PROSE), (2, other), (None, ""), (None, ""), (None, "lone text"), (None, "twice"), (None, "twice")]
    df = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], brute.DOCS)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, df, folder).collect()]
    assert sorted(got, key=str) == sorted([(2, brute.PROSE), (2, other), (None, ""), (None, ""), (None, "lone text"), (None, "twice")], key=str)
    spark.createDataFrame([(1, brute.PROSE)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, df, folder).collect()]
    assert sorted(got, key=str) == sorted([x for x in rows if x[1] != brute.PROSE], key=str)


def test_fingerprints_of_very_many_hashes(spark):
    """Counters of one bit don't run into the next: one hash 70 000 times, and more hashes than a short counter counts."""
    from opspark.llm import decontaminate

    many = spark.range(1).select(F.array_repeat(F.lit(0x0123456789ABCDEF), 70_000).alias("a"), F.transform(F.sequence(F.lit(1), F.lit(140_001)), lambda i: F.xxhash64(i)).alias("b"))
    row = many.select(decontaminate.simhash(F.col("a")).alias("a"), decontaminate.simhash(F.col("b")).alias("b"), F.col("b").alias("all")).first()
    import numpy as np

    assert row.a == 0x0123456789ABCDEF
    bits = (np.array(row["all"], np.int64).view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = sum(1 << int(k) for k in np.flatnonzero(bits.sum(0) * 2 > 140_001))
    assert row.b & (1 << 64) - 1 == want


def test_sketches_hold_back_chance_meetings_only():
    """Lines of 101 to 600 characters at a similarity of 0.8 to 0.85 stay together, unlike ones of one bucket part; short ones are never parted."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(21)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    texts, similar = [], 0
    while similar < 1500:
        n = int(rng.integers(101, 600))
        a = rng.choice(letters, n)
        b = a.copy()
        b[rng.choice(n, max(n * 22 // 1000, 1), replace=False)] = "é"
        pair = ["x" + "".join(v) + "x" for v in (a, b)]
        sets = lines.line_sets(pair)
        if 0.8 <= len(np.intersect1d(*sets)) / len(np.union1d(*sets)) < 0.85:
            texts += pair
            similar += 1
    held = lines.Lines(*_text_arrays(texts))
    sketch, full = lines._sketches(held, np.arange(len(texts)))
    assert len(lines.alike(np.arange(len(texts)) // 2, sketch, full)) == similar
    # the first of each pair only, ten to a bucket: nothing similar
    firsts = np.ascontiguousarray(sketch[::2])
    long = full[::2] >= lines.SKETCHED
    assert long.sum() > 1000 and not len(lines.alike(np.arange(long.sum()) // 10, np.ascontiguousarray(firsts[long]), full[::2][long]))
    assert len(lines.alike(np.zeros(4, int), firsts[:4], np.zeros(4, int))) == 6


def _text_arrays(texts):
    import pyarrow as pa

    from opspark.llm.common import texts_of

    # a line per text, and all of them in one
    return texts_of(pa.array(["\n".join(texts)], pa.large_string()))


def test_packed_bands_meet_as_unpacked_ones(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lines, "PACKED", 300)
    texts = [f"{a} of the lines that are nearly the same, number {i % 7}" for a in ("one", "two") for i in range(40)] + ["other", "", " other "]
    given = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 20])], names=["text"]) for i in range(0, len(texts), 20)]
    rows = {(r["band"], r["class"]) for b in lines._bands(iter(given)) for r in b.to_pylist()}
    want = {}
    for band, name in rows:
        want.setdefault(band, set()).add(name)
    want = sorted(sorted(v) for v in want.values() if len(v) > 1)
    packed = sorted((r for b in lines._packed_bands(iter(given)) for r in b.to_pylist()), key=lambda r: r["part"])
    cut = [pa.RecordBatch.from_pylist(packed[i : i + 17], schema=pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("names", pa.binary())]))
           for i in range(0, len(packed), 17)]
    got = {}
    for b in lines._met_packed(iter(cut)):
        for r in b.to_pylist():
            got.setdefault(r["band"], set()).add(r["class"])
    assert sorted(sorted(v) for v in got.values()) == want and want


def test_query_drops_what_the_operator_drops(spark, folder):
    rows = [(i, "\n".join(f"{'a line that stands in several of the texts' if j % 3 else 'line'} {j * (1 + i % 4)}" for j in range(12))) for i in range(30)] + [(None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    want = {}
    for r in lines.fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        want.setdefault(r.doc_id, []).append((r.line, r.kept))
    got = {r.doc_id: (r.n_lines, r.n_kept, list(r.dropped)) for r in lines.op2_fuzzy_lines(spark, folder).collect()}
    assert got == {d: (len(v), sum(k for _, k in v), sorted(n for n, k in v if not k)) for d, v in want.items()}


def test_lines_do_not_depend_on_how_texts_are_cut(monkeypatch):
    """Texts are handled in runs of LINE_BYTES, whose arrays stay small, with the same names, band keys, texts and links."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(31)
    alphabet = list("abcdefgh \t\néß𝒳")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 120)))) for _ in range(300)]
    texts += [f"the same beginning of several lines, number {i}" for i in range(30)]
    texts += ["", " ", "\n", "abc", "abcd", "abcde", "  abcd\r\n\x0b e ", "", None, "x" * 5000, " " * 700 + "y" + " " * 700 + "\nz"]
    given = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])

    class Everything:
        value = np.full(1 << 10, (1 << 64) - 1, np.uint64)

    sizes, init = [], lines.Lines.__init__
    monkeypatch.setattr(lines.Lines, "__init__", lambda self, data, offsets: (sizes.append((len(data), len(offsets))), init(self, data, offsets))[1])
    results = []
    for size in (1, 100, lines.LINE_BYTES):
        monkeypatch.setattr(lines, "LINE_BYTES", size)
        bands = {(r["band"], r["class"]) for b in lines._bands(iter([given])) for r in b.to_pylist()}
        found = {tuple(r.values()) for b in lines._line_texts(Everything, iter([given])) for r in b.to_pylist()}
        every = sorted({r[1] for r in found})
        results.append((bands, found, lines.linked_inside(every, np.arange(len(every)) // 9, 60).tolist()))
        assert all(n <= max(size, 5000) or rows == 2 for n, rows in sizes)
    assert results[0] == results[1] == results[2] and results[0][2]
    # the texts sent are the trimmed lines
    want = {s for t in texts if t for line in t.split("\n") if (s := line.strip(" \t\n\r\x0b\x0c"))}
    assert {r[1] for r in results[0][1]} == want
    # a batch above the bound goes in several runs
    del sizes[:]
    long = pa.RecordBatch.from_arrays([pa.array(["a line of some words\n" * 1000] * 60)], names=["text"])
    list(lines._bands(iter([long])))
    assert max(n for n, _ in sizes) <= lines.LINE_BYTES < sum(n for n, _ in sizes)


def test_texts_that_share_an_n_gram_by_chance_are_no_candidates(spark, monkeypatch):
    """A row of texts, each with one run of four words of the next, was one candidate group; near copies among them still meet."""
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) + " " + " ".join(f"w{i + 1}x{j}" for j in range(4)) for i in range(40)]
    near = texts[7].replace("w7x29", "other")
    met = []
    verified = ngram_join.verified_components
    monkeypatch.setattr(ngram_join, "verified_components", lambda pairs, *rest, **options: met.append(pairs.count()) or verified(pairs, *rest, **options))
    df = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(df, percent=75).collect()}
    assert met == [1] and got == {i: 7 if i == 40 else i for i in range(41)}


def test_chains_count_meetings():
    """Short chains give pairs with their meetings, long ones heads; lengths too unlike and small sets are told apart."""
    rows = [(1, 100, False, 5), (1, 100, True, 6), (1, 200, False, 7), (1, 201, False, 8)]
    rows += [(2, 100, False, 5), (2, 100, False, 6)] + [(3, 3, False, 1), (3, 3, False, 2)] + [(4, 50, False, 100 + i) for i in range(ngram_join.SHORT + 3)]
    got = {}
    for size in (1, 3, len(rows)):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=["token", "n", "late", "class"]) for i in range(0, len(rows), size)]
        pairs = {}
        for b in ngram_join._chains(85, iter(batches)):
            for a, c, times in zip(*(b.column(x).to_pylist() for x in ("a", "b", "times"))):
                pairs[a, c] = pairs.get((a, c), 0) + times
        got[size] = pairs
    many = ngram_join.MEETS
    want = {(5, 6): 2, (7, 8): 1, (1, 2): many} | {(100, 100 + i): many for i in range(1, ngram_join.SHORT + 3)}
    assert got[1] == got[3] == got[len(rows)] == want
