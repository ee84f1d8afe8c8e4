"""Periodic runs against a plain search of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from opspark.llm import runs
from tests.conftest import SF


def brute(words, least=6, repeats=4):
    """Every lag, every maximal stretch on it, smallest periods only."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1 if n >= least else 0):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, repeats * q):
                part = words[i : i + length]
                if not any(all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda t: (-t[1], t[0], t[2])) if found else None
    return (
        doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_against_brute_force(spark):
    got = {r[0]: tuple(r) for r in runs.op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        if len(d.text) < 15_000:
            assert got[d.doc_id] == expected(d.doc_id, d.text)
    assert sum(r[1] for r in got.values()) > 20


@pytest.mark.parametrize("least,repeats", [(6, 4), (6, 3), (20, 4), (2, 3), (9, 5)])
def test_arrays_against_brute_force(least, repeats):
    draw = random.Random(least * 10 + repeats)
    for _ in range(200):
        docs = []
        for _ in range(draw.randint(1, 5)):
            letters = "abc"[: draw.randint(1, 3)]
            w = [draw.choice(letters) for _ in range(draw.randint(0, 40))]
            if draw.random() < 0.6:
                unit = [draw.choice("abc") for _ in range(draw.randint(1, 9))]
                w += (unit * 6)[: draw.randint(4, 50)] + [draw.choice("abc") for _ in range(draw.randint(0, 10))]
            docs.append(w)
        counts = np.array([len(w) for w in docs])
        ends = np.cumsum(counts)
        document = np.repeat(np.arange(len(docs)), counts)
        ids = np.array([hash(x) for w in docs for x in w], np.int64).view(np.uint64)
        got = runs.find_runs(ids, document, ends[document], least, repeats)
        want = [(s + ends[i] - counts[i], n, q) for i, w in enumerate(docs) for s, n, q in brute(w, least, repeats)]
        assert [tuple(map(int, r)) for r in got] == [tuple(map(int, r)) for r in want]


def test_long_repeats_and_overlapping_runs():
    """A doubled pattern without a unique gram, and one word many thousand times."""
    unit = list("aabab") * 5 + list("b")
    words = unit * 4 + ["x"] * 50_000 + list("cd") * 9
    ids = np.array([hash(w) for w in words], np.int64).view(np.uint64)
    document = np.zeros(len(words), np.int64)
    got = {tuple(map(int, r)) for r in runs.find_runs(ids, document, np.full(len(words), len(words)))}
    assert {(0, 104, 26), (104, 50_000, 1), (50_104, 18, 2)} <= got
    assert {r for r in got if r[0] < 104} == set(brute(unit * 4))


def test_odd_rows(spark):
    """Nulls, empty and blank texts, repeated rows, clashing and extra columns, a null and a repeated id; an empty table."""
    long = " ".join(["w%d" % (i % 700) for i in range(20_000)])
    rows = [(1, "a b " * 6, 5, "x"), (1, "a b " * 6, 5, "x"), (None, "q q q q q q", None, None), (3, None, 1, None), (4, "", 1, ""), (5, " \t\n", 1, ""),
            (6, "A a A a A a a", 0, ""), (7, long, 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, n_words string")
    got = sorted((tuple(r) for r in runs.periodic_runs(df).collect()), key=str)
    by = {r[0]: r for r in got}
    assert len(got) == 8 and [r[0] for r in got].count(1) == 2
    assert by[1][1] == 12 and by[1][2] == [Row(start=0, length=12, period=2)] and by[1][3] == "a b"
    assert by[None][2] == [Row(start=0, length=6, period=1)] and by[None][3] == "q"
    assert all(by[i][1:] == (0, [], "") for i in (3, 4, 5))
    assert by[6][2] == [] and by[6][3] == "A a A a A a a"
    assert by[7][2] == [Row(start=0, length=20_000, period=700)] and len(by[7][3].split()) == 700
    assert runs.planted(df).where("doc_id is null").first()["text"] == "q q q q q q"
    assert runs.periodic_runs(df.limit(0)).collect() == []
