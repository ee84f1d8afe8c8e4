"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a sample of other texts, whose labels are not looked at, is the unlabelled side. The
risk of a linear model is the class prior times the positives' loss plus the part of the unlabelled loss that the
positives, at that prior, don't account for; where that part turns negative the model has begun to learn the positives by heart, and
a step is taken against it. Features are the presence of whole words and of word beginnings, as hashes; those that the
unlabelled side holds more rarely than the prior explains are kept, by a corrected log-ratio. Several such numpy classifiers, each
on its own part of the sample, are averaged. The unlabelled side is drawn from all texts that may be learned from, positives
included, so that the prior holds for it.

The sample is bounded and chosen by digest; neither its texts nor all its features come to the driver. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opspark.llm.common import chunks, digits, mix, small_batches, span_hashes, table, texts_of, words
from opspark.session import cut_lineage

#: Bounds of the training sample, in texts. The digest of the id draws them, so the number drawn is off by a tenth at most
#: beside chance; features are counted by Spark, and only the kept ones come to the driver.
POSITIVES = 3000
UNLABELLED = 9000

#: Features kept, models averaged, lengths of word beginnings (in bytes) beside whole words.
KEPT = 600
MODELS = 5
BEGINNINGS = (4, 5, 6)

#: How much more often positives than negatives must show a feature.
LEAST_RATIO = 5.0

#: Bytes at the ends of a word that are not part of it: ASCII punctuation.
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def features(column: pa.Array):
    """(row, sorted distinct feature hashes) of each text; none for null, empty texts and bare punctuation."""
    data, offsets = texts_of(column)
    for start, stop in chunks(offsets):
        part = offsets[start : stop + 1]
        own = data[part[0] : part[-1]]
        starts, ends, counts, running = words(own, part - part[0])
        for _ in range(3):  # strip up to three marks at each end
            if len(starts):
                starts = starts + (_PUNCTUATION[own[starts]] & (ends - starts > 1))
                ends = ends - (_PUNCTUATION[own[ends - 1]] & (ends - starts > 1))
        row = np.repeat(np.arange(stop - start), counts)
        hashes, rows = [span_hashes(starts, ends, running)], [row]
        for n in BEGINNINGS:
            longer = ends - starts >= n
            hashes.append(mix(span_hashes(starts[longer], starts[longer] + n, running) + np.uint64(n)))
            rows.append(row[longer])
        hashes, rows = np.concatenate(hashes), np.concatenate(rows)
        order = np.argsort(rows, kind="stable")
        at = np.searchsorted(rows[order], np.arange(stop - start + 1))
        hashes = hashes[order]
        for i in range(stop - start):
            yield start + i, np.unique(hashes[at[i] : at[i + 1]])


@dataclass
class Model:
    """Averaged linear models over the presence of features."""

    keys: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def logits(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        if len(self.keys):
            for row, found in features(column):
                at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
                out[row] += self.weights[at[self.keys[at] == found]].sum()
        return out


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id is never held out and never labelled."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _chosen(df: DataFrame, have: int, want: int) -> DataFrame:
    """About ``want`` of the ``have`` rows, by the digest of the id in ``order``."""
    span = 1 << 48
    level = span if have <= want else int(span * min(1.0, 1.1 * want / have + 50 / have))
    return df.withColumn("order", digits(F.lit("toxicity"), F.col("doc_id"))).where(F.col("order") < level)


def _found(chosen: DataFrame, positive: bool) -> DataFrame:
    """(order, positive, found): the features of the chosen texts (order, text)."""
    small_batches(chosen.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([f.view(np.int64) for _, f in features(b.column("text"))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("order"), found], names=["order", "found"])

    rows = chosen.select("order", "text").mapInArrow(extract, "order long, found array<long>")
    return rows.select("order", F.lit(positive).alias("positive"), "found")


def _telling(sample: DataFrame, texts: dict[bool, int], prior: float) -> np.ndarray:
    """The KEPT most telling features, as sorted hashes; counted by Spark, so only these come to the driver."""
    counts = sample.select("positive", F.explode("found").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("positive")).alias("p"), F.count_if(~F.col("positive")).alias("u"))
    p_rate = F.col("p") / texts[True]
    # what the unlabelled side shows beyond the prior's share of positives is the negatives' rate
    n_rate = F.greatest(F.col("u") / texts[False] - prior * p_rate, F.lit(0.0)) / (1 - prior)
    ratio = (p_rate + 1e-4) / (n_rate + 1e-3)
    best = counts.where((F.col("p") >= 3) & (ratio >= LEAST_RATIO)).orderBy((p_rate * F.log(ratio)).desc(), "feature").limit(KEPT)
    return np.sort(np.array([r.feature for r in best.select("feature").collect()], np.int64).view(np.uint64))


def _places(sample: DataFrame, keys: np.ndarray) -> dict[bool, list[list[int]]]:
    """For each text of either side the places of the kept features that it shows."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.column("found"):
                found = row.values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                out.append(at[keys[at] == found])
            yield pa.RecordBatch.from_arrays([b.column("order"), b.column("positive"), pa.array(out, pa.list_(pa.int64()))], names=["order", "positive", "at"])

    sides: dict[bool, list[list[int]]] = {True: [], False: []}
    for r in sample.mapInArrow(place, "order long, positive boolean, at array<long>").orderBy("order", "at").collect():
        sides[r.positive].append(r.at)
    return sides


def fit(sides: dict[bool, list[list[int]]], keys: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Train on the places of the features that the texts of both sides show."""

    def matrix(rows: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(rows), len(keys)), np.float32)
        for i, at in enumerate(rows):
            out[i, at] = 1
        return out

    p, u = matrix(sides[True]), matrix(sides[False])
    bias = float(np.log(prior / (1 - prior)))
    weights = np.zeros(len(keys))
    for m in range(MODELS):
        rng = np.random.default_rng(seed + m)
        w, _ = nn_pu(p[rng.random(len(p)) < 0.8] if len(p) > 20 else p, u[rng.random(len(u)) < 0.8] if len(u) > 20 else u, prior, bias)
        weights += w / MODELS
    # the mean score of the unlabelled side is the prior: the bias is set so, by halving
    z, low, high = u @ weights, -30.0, 30.0
    for _ in range(60):
        shift = (low + high) / 2
        low, high = (low, shift) if (1 / (1 + np.exp(-(z + shift)))).mean() > prior else (shift, high)
    return Model(keys, weights, float(shift))


def nn_pu(p: np.ndarray, u: np.ndarray, prior: float, bias: float, steps: int = 500, rate: float = 0.1, decay: float = 1e-4):
    """Weights and bias of a logistic model under the non-negative positive-unlabelled risk, by Adam."""
    w, b = np.zeros(p.shape[1], np.float32), np.float32(bias)
    m, v = np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)
    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        as_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # gradients by score: positives as positive, and the negatives' part of the risk
        gp, gn_p, gn_u = prior * (sp - 1) / len(p), -prior * sp / len(p), su / len(u)
        if as_negative < 0:
            gp, gn_p, gn_u = np.zeros_like(gp), -gn_p, -gn_u
        g = np.concatenate([p.T @ (gp + gn_p) + u.T @ gn_u + decay * w, [(gp + gn_p).sum() + gn_u.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), np.float32(b - step[-1])
    return w.astype(float), float(b)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels that may be learned: toxic = 1 is a confirmed positive, all other texts are unlabelled.

    The class prior is the positive share of those labels. Without a positive or an unlabelled text, and where no feature
    tells them apart, the model says the prior. Null labels count as no label; of repeated labels the largest holds.
    """
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, known = labels.agg(F.sum((F.col("toxic") == 1).cast("long")), F.count("*")).first()
    toxic_ids = labels.where("toxic = 1").select("doc_id")
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    # so few ids, bounded by the sample, that no text need be shuffled to meet them
    toxic_ids = F.broadcast(_chosen(toxic_ids, toxic or 0, POSITIVES).select(F.col("doc_id").alias("toxic_id")))
    positives = _found(_chosen(texts.join(toxic_ids, F.col("doc_id") == F.col("toxic_id")), 0, 1), True)
    unlabelled = _found(_chosen(texts, texts.select("doc_id").count(), UNLABELLED), False)
    sample = cut_lineage(positives.unionByName(unlabelled))
    prior = min(max((toxic or 0) / known if known else 0.1, 1e-3), 0.5)
    counts = {True: 0, False: 0} | {r.positive: r["count"] for r in sample.groupBy("positive").count().collect()}
    keys = _telling(sample, counts, prior) if all(counts.values()) else np.zeros(0, np.uint64)
    if not len(keys):
        return Model(keys, np.zeros(0), float(np.log(prior / (1 - prior))))
    return fit(_places(sample, keys), keys, prior)


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """Probability that a text is toxic; an empty or null text gets the model's base rate."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(1 / (1 + np.exp(-sent.value.logits(pa.array(batch, pa.string(), from_pandas=True)))))

    return scores(text)


def op10_pu_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs, table(spark, folder, "labels"))
    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score(spark, docs["text"], model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))
