"""Spelling variants against a plain search over all words without one letter."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from opspark.llm import spelling
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(n):
    """word -> (word, n, n_near, form, form_n, root)."""
    by, near = defaultdict(set), {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            by[(w[:i], w[i + 1 :])].add(w)
    for w in n:
        for i in range(len(w)):
            near[w] |= by[(w[:i], w[i + 1 :])] - {w}
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def check(df, want):
    got = {r[0]: tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == want


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(counts(docs))
    assert sum(v[3] is not None for v in want.values()) > 5
    check(spelling.op12_spelling_variants(spark, SF), want)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_dense_words_against_brute_force(spark, monkeypatch, hot):
    """Few letters, so that words have many neighbours, doubled letters, words of 32 to 34 letters, and chains of forms."""
    monkeypatch.setattr(spelling, "HOT", hot)
    draw = random.Random(hot)
    n = {}
    for _ in range(300):
        n["".join(draw.choice("abé") for _ in range(draw.choice([7, 7, 8, 9, 12])))] = draw.choice([2, 3, 20, 40, 400, 5000])
    for w in list(n)[:20]:
        at = draw.randrange(len(w))
        n[w[:at] + draw.choice("ab") + w[at:]] = 2
    for size in (31, 32, 33, 34, 200):
        base = "".join(draw.choice("ab") for _ in range(size))
        n[base], n[base + "a"], n[base[1:]], n["b" + base[1:-1] + "c"] = 900, 2, 30, 3
        n[base[: size // 2] + "c" + base[size // 2 + 1 :]] = 4
    want = brute(n)
    check(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")), want)
    assert any(v[3] and v[3] != v[5] for v in want.values())


def test_odd_rows(spark):
    """Null ids and texts, empty texts, repeated rows, clashing columns, one very long word, capitals outside A-Z; an empty table."""
    word = "ÉTONNANTE×ÿ"
    giant = "ab" * 30_000
    rows = [(None, word, 1, "x"), (None, word, 1, "x"), (1, None, None, None), (2, "", 0, ""), (3, "short w0rds only", 0, ""),
            (None, giant, 0, ""), (None, giant, 0, ""), (None, giant[:-1], 0, ""), (None, giant[:-1], 0, "")] + [(None, "sentence", 0, "")] * 20 + [(None, "sentense", 0, "")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int, n string")
    want = brute(counts([(r[0], r[1]) for r in rows]))
    assert "Étonnante×ÿ" in want and want["sentense"][3] == "sentence" and want[giant][2] == 1
    check(spelling.variants(spelling.counted_words(spelling.thinned(spelling.letter_runs(docs)))), want)
    assert spelling.variants(spelling.counted_words(spelling.thinned(spelling.letter_runs(docs.limit(0))))).collect() == []
