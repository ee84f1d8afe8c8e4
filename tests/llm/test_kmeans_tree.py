"""Nearest neighbours against a comparison with every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspark.llm import kmeans_tree
from tests.conftest import SF


def brute(ids, x, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        score[i] = -np.inf
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score))[:k] if np.isfinite(score[j])]
    return out


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def share(got, want):
    met = sum(len({v for _, v, _ in got.get(q, [])} & {v for v, _ in near}) for q, near in want.items())
    return met / sum(map(len, want.values()))


def test_query_recall_order_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = lists(kmeans_tree.op13_kmeans_tree(spark, SF).collect())
    assert share(got, brute(ids, x, 20, 20)) >= 0.9
    place = {int(v): i for i, v in enumerate(ids)}
    for q, near in got.items():
        assert [n for n, _, _ in near] == list(range(1, 21)) and q not in {v for _, v, _ in near}
        assert near == sorted(near, key=lambda r: (-r[2], r[1]))
        assert all(s == pytest.approx(float(x[place[q]] @ x[place[v]]), abs=1e-12) for _, v, s in near)


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_recall_on_lengths_that_differ_and_on_clusters(spark, monkeypatch, spread):
    """Vectors of very unlike lengths, and tight clusters; small bins, so that leaves are cut into blocks and queries into crowds."""
    monkeypatch.setattr(kmeans_tree, "BIN", 40)
    monkeypatch.setattr(kmeans_tree, "ASKING", 25)
    draw = np.random.default_rng(3)
    x = draw.normal(size=(12, 24))[draw.integers(0, 12, 3000)] + spread * draw.normal(size=(3000, 24))
    x *= np.exp(draw.normal(0, 0.5 * spread, (3000, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    # the tree sees a third of the rows
    out, index = kmeans_tree.nearest(df, F.col("vec_id") % 10 == 0, 10, sample=1000)
    assert share(lists(out.collect()), brute(np.arange(3000), x, 10, 10)) >= 0.9
    assert index.tree.leaves > 30 and index.visits < index.tree.leaves


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "HOT", 3)
    one = [1.0, 0.0, 0.0]
    rows = [(i, one, 1, "x") for i in range(0, 60)]  # one vector for most rows
    rows += [(60, [0.0, 1.0, 0.0], 1, ""), (61, [0.0, 2.0, -0.0], None, None), (61, [0.0, 2.0, 0.0], 1, "repeated"), (62, [0.0, 2.0, 0.0], 1, "")]
    rows += [(80, None, 1, ""), (100, [], 1, ""), (120, [0.0, 0.0, 0.0], 1, ""), (140, [1.0, None, 0.0], 1, ""), (160, [1.0, float("nan"), 0.0], 1, ""),
             (180, [float("inf"), 0.0, 0.0], 1, ""), (None, one, 1, ""), (200, [3.0, 1.0], 1, ""), (201, [1.0, 1.0], 1, ""), (220, [5.0], 1, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, ids int, query string")
    got = lists(kmeans_tree.nearest(df, F.col("vec_id") % 20 == 0, 20)[0].collect())
    for q in (0, 20, 40):
        assert got[q] == [(n + 1, v, 1.0) for n, v in enumerate([v for v in range(60) if v != q][:20])]
    assert got[60] == [(1, 61, 2.0), (2, 62, 2.0)] + [(n + 3, n, 0.0) for n in range(18)]
    assert got[200] == [(1, 201, 4.0)]
    assert set(got) == {0, 20, 40, 60, 200}
    assert kmeans_tree.nearest(df.limit(0), F.col("vec_id") % 20 == 0)[0].collect() == []
    assert kmeans_tree.nearest(df.where("vec_id = 1"), F.col("vec_id") % 20 == 0)[0].collect() == []
    assert kmeans_tree.nearest(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0)[0].collect() == []
