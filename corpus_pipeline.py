"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

Every stage reads all that its predecessor kept and returns the columns of documents as it got them, extra ones included; the
last adds ``shard`` and ``slot``. Rows with null or repeated doc_ids are documents of their own: near-duplicate and
decontamination decisions go by a digest of the text. An empty table passes through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from opspark.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from opspark.llm.common import table, word_count
from opspark.session import bounded_broadcast, cut_lineage, shared_folder


def _fresh(columns: list[str], name: str) -> str:
    """A column name that is not taken."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a score of 0.3 or more go. Null and empty texts have the base rate and stay."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(spark, docs["text"], model) < 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of documents linked by five-word shingles at a similarity of 0.8, one with the smallest doc_id stays.

    Null ids come last. Of rows with that doc_id the text with the smallest digest stays, and one row of it. Texts
    without words link with nothing and stay.
    """
    digest = F.xxhash64("text")
    groups = ngram_join.similar_groups(docs.select(digest.alias("doc_id"), "text"), k=5, percent=80).where("n_shingles > 0")
    texts = cut_lineage(groups.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count("*").alias("copies")))
    large = texts.groupBy("component").agg(F.sum("copies").alias("rows")).where("rows > 1").select("component")
    members = bounded_broadcast(cut_lineage(texts.join(large, "component").select(F.col("doc_id").alias("of"), "component")))
    # rows of a large component, by (doc_id, text)
    rows = docs.select("doc_id", digest.alias("key")).join(members, F.col("key") == F.col("of")).groupBy("component", "doc_id", "key").agg(F.count("*").alias("rows"))
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "rows")).alias("first"))
    decided = cut_lineage(members.join(first, "component").select("of", "component", "first.doc_id", "first.key", "first.rows"))
    of, component, first_id, key, many = names = [_fresh(docs.columns, f"near_{c}") for c in decided.columns]
    decided = decided.toDF(*names)
    # five numbers a row: beyond the usual bound they are still less than the texts, which a shuffle join would move
    met = docs.join(bounded_broadcast(decided, ngram_join.PLACED), F.xxhash64(docs["text"]) == decided[of], "left").where(
        F.col(of).isNull() | (F.col(of) == F.col(key)) & docs["doc_id"].eqNullSafe(decided[first_id]))
    kept = met.where(F.col(of).isNull() | (F.col(many) == 1))
    if not decided.where(F.col(many) > 1).isEmpty():
        kept = kept.unionByName(met.where(F.col(many) > 1).dropDuplicates([component]))
    return kept.drop(*names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    found = decontaminate.contaminated(docs.select(F.xxhash64("text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = bounded_broadcast(found.select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, F.xxhash64(docs["text"]) == gone["gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one row per use of a document in the mix, in training order; unused documents go."""
    size = _fresh(docs.columns, "mix_size")
    mixed = mixing.mix(docs.withColumn(size, word_count(docs["text"])), ["doc_id", size], size=size)
    return mixing.training_order(mixed).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: 40 shards whose row counts differ by one at most."""
    placed = sharding.assign(docs, ["doc_id"])
    return placed.select(
        *(F.col("row")[c].alias(c) for c in docs.columns),
        F.col("shard").alias(_fresh(docs.columns, "shard")), F.col("slot").alias(_fresh(docs.columns, "slot")))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", assign_shards),
]

#: A learned model decides in the first stage, so SQL can't state the rows; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is a table in the shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
