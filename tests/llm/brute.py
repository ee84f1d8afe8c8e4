"""Plain versions of the operators, and tables with the odd cases that all of them must bear."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the quick brown fox jumps over a lazy dog while seven wizards brew strong tea near the old mill by the river bend today"


def odd_documents(spark, extra: str = ""):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, and columns of clashing names."""
    near = PROSE.replace("seven", "eight")
    long = " ".join(f"word{i % 977} item{i}" for i in range(30_000))
    rows = [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "b", 1), (2, PROSE, "en", "b", 1), (3, near, "en", "a", 1), (4, "", "en", "a", 0),
        (5, None, None, None, None), (6, "   \n\t ", "en", "b", 5), (None, PROSE, "en", "c", 1), (None, None, None, None, None), (7, long, "de", "a", 9),
        (8, "one two", "en", None, 7), (9, "ONE two", "en", "é", 7), (10, "one  TWO", "en", "Z", 7), (11, "!?", "en", "a", 2), (12, "\U0001F600 ß", "en", "", 3),
    ]
    rows += [(100 + i, f"copy of a line {PROSE} {i % 3}", "en", "a", 1) for i in range(40)]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "n_chars AS shard", "'x' AS size", "'y' AS point", "1 AS row", "'z' AS class") if extra else df


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def word_sets(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_groups(rows, k, percent):
    """[(doc_id, set size, component)] of (doc_id, text) rows, by comparing all of them."""
    sets = [word_sets(t, k) for _, t in rows]
    index = defaultdict(list)
    links = set()
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in index[g])
        links |= {(j, i) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)}
        for g in s:
            index[g].append(i)
    root = components(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return [(d, len(sets[i]), least.get(root[i]) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def leaks(docs, items, percent=80):
    """{(doc_id, item_id): similarity} by trying every window."""
    bags, out = [], {}
    for item, text in items:
        w = WORD.findall((text or "").lower())
        if w:
            k = min(5, len(w))
            bags.append((item, len(w), k, Counter(tuple(w[a : a + k]) for a in range(len(w) - k + 1))))
    for doc, text in docs:
        w = WORD.findall((text or "").lower())
        for item, size, k, bag in bags:
            runs = [tuple(w[a : a + k]) for a in range(len(w) - k + 1)]
            if not bag.keys() & set(runs):
                continue
            for s in range(max(1, len(w) - size + 1)):
                window = Counter(runs[s : s + size - k + 1])
                shared, both = sum((window & bag).values()), sum((window | bag).values())
                if shared * 100 >= both * percent:
                    out[doc, item] = max(out.get((doc, item), 0), shared / both)
    return out


def line_keys(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\r\v\f")) for x in (text or "").split("\n")]


def kept_lines(rows, k=5, percent=80):
    """{(doc_id, line): kept} by comparing all lines."""
    places = [(d, i, key) for d, t in rows for i, key in enumerate(line_keys(t))]
    sets = {key: {key[a : a + k] for a in range(max(1, len(key) - k + 1))} for _, _, key in places if key}
    index, links = defaultdict(list), set()
    for key, s in sets.items():
        for other, n in Counter(o for g in s for o in index[g]).items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                links.add((other, key))
        for g in s:
            index[g].append(key)
    root = components(sets, links)
    first = {}
    order = lambda d, i: (d is None, d or 0, i)
    for d, i, key in places:
        if key:
            first[root[key]] = min(first.get(root[key], order(d, i)), order(d, i))
    return {(d, i): not key or first[root[key]] == order(d, i) for d, i, key in places}
