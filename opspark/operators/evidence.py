"""Evidence records: assembly, canonical text, digests and checking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Record fields and defaults.
EVIDENCE_VERSION = "1.0"
SIGNING_ALGORITHM = "RSASSA_PKCS1_V1_5_SHA_256"
EVIDENCE_FIELDS = ["commit", "evidence_version", "image_digest", "run_id", "signing_algorithm", "terraform_hash", "timestamp"]


def assemble(df: DataFrame, timestamp: Column, commit: Column, run_id: Column, content: Column,
             image_digest: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The seven text fields of an evidence record; an absent image digest is empty."""
    return df.select(
        *keep, timestamp.alias("timestamp"), commit.alias("commit"), run_id.cast("string").alias("run_id"),
        F.sha2(content, 256).alias("terraform_hash"),
        F.coalesce(image_digest if image_digest is not None else F.lit(None).cast("string"), F.lit("")).alias("image_digest"),
        F.lit(EVIDENCE_VERSION).alias("evidence_version"), F.lit(SIGNING_ALGORITHM).alias("signing_algorithm"))


def canonical_json(fields: Sequence[str] = EVIDENCE_FIELDS) -> Column:
    """JSON text with sorted keys, ``", "`` between pairs and ``": "`` after keys."""
    pairs = []
    for name in sorted(fields):
        body = F.to_json(F.array(F.col(name)), {"ignoreNullFields": "false"})
        pairs.append(F.concat(F.lit(f'"{name}": '), F.substring(body, F.lit(2), F.length(body) - 2)))
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def sign(df: DataFrame, fields: Sequence[str] = EVIDENCE_FIELDS) -> DataFrame:
    """Add the base64 digest of the canonical text."""
    return df.withColumn("signature", F.base64(F.unhex(F.sha2(canonical_json(fields), 256))))


def verify(evidence: DataFrame, signatures: DataFrame, keys: Sequence[str] = ("date", "run_id"),
           fields: Sequence[str] = EVIDENCE_FIELDS) -> DataFrame:
    """valid / invalid / missing_signature / missing_evidence per record key."""
    made = evidence.select(*keys, F.base64(F.unhex(F.sha2(canonical_json(fields), 256))).alias("_made"))
    held = signatures.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("signature").alias("_held"))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    status = (F.when(F.col("_made").isNull(), "missing_evidence").when(F.col("_held").isNull(), "missing_signature")
              .when(F.col("_made") == F.col("_held"), "valid").otherwise("invalid"))
    return made.join(held, on, "full").select(
        *[F.coalesce(k, f"_k_{k}").alias(k) for k in keys], status.alias("status"))
