"""WARC archives with revisits resolved by payload digest.

Headers alone are shuffled by payload digest to find, for each payload that comes more than once, its first page. Rows then
learn whether they are that page or a revisit of it, and are written as WARC records by Spark's text writer: a value is a
record's header block and content, and the line separator is the blank line that ends a record. Reading goes through Spark's
text reader with the same separator; pieces come in file order and are put together by Content-Length, one record at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opspark.llm.common import small_batches, table
from opspark.session import cut_lineage, shared_folder

END = "\r\n\r\n"

#: Fixed values of the WARC 1.1 standard and of HTTP.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

#: The pages carry no time; every record of a run gets this one.
DATE = "2024-01-01T00:00:00Z"

RECORD = "page_id long, url string, record_id string, record_type string, refers_to_id string, payload_digest string, payload_bytes long, payload binary"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1."""
    sha = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*values: Column) -> Column:
    text = F.md5(F.concat_ws("|", *(F.coalesce(v.cast("string"), F.lit("\\N")) for v in values)))
    cut = [F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, first_id, first_url, record_type) of each page.

    A null page has an empty payload. Of equal payloads of at least ``min_bytes``, the smallest page_id is the response and
    others revisit it; null page ids come after all others. Rows that share the smallest page_id are all
    responses, for the page id is a record's identity. Smaller payloads are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    # only digests that repeat are kept; written down, so that a join with a much repeated digest can be split
    again = cut_lineage(
        rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first"))
        .where("copies > 1").select("payload_digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    revisit = F.col("again_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (
        rows.join(again.withColumnRenamed("payload_digest", "again_digest"), F.col("payload_digest") == F.col("again_digest"), "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    )


def write_archive(resolved: DataFrame, path: str, date: str = DATE) -> None:
    """Write resolved pages as gzipped WARC files, one per task, each led by no shared state.

    Headers are fresh: record ids come from page id, address and digest. A null address becomes ``urn:page:ID``; white
    space and control characters in an address are escaped.
    """
    address = lambda url, page: F.regexp_replace(F.coalesce(url, F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("none")))), r"[\x00-\x20\x7F]", "%20")
    revisit = F.col("record_type") == "revisit"
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit(END))
    length = F.octet_length(head) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _uuid(F.col("page_id"), F.col("url"), F.col("payload_digest"))), field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", address(F.col("url"), F.col("page_id"))),
        F.when(F.col("page_id").isNull(), "").otherwise(field("X-Page-ID", F.col("page_id").cast("string"))),
        F.when(F.col("url").isNull(), field("X-No-URI", F.lit("1"))).otherwise(""),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            field("WARC-Profile", F.lit(REVISIT_PROFILE)),
            field("WARC-Refers-To", _uuid(F.col("first_id"), F.col("first_url"), F.col("payload_digest"))),
            field("WARC-Refers-To-Target-URI", address(F.col("first_url"), F.col("first_id"))),
        )).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), F.lit("Content-Length: "), length.cast("string"), F.lit(END))
    record = F.concat(headers, head, F.when(revisit, "").otherwise(F.col("payload").cast("string")))
    resolved.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files that ``write_archive`` or another writer made, one row each.

    A revisit's payload is null and its payload_bytes is what its HTTP header says. A gzipped file is one task; files have
    the size of the writer's tasks. A file that ends inside a record raises an error.
    """
    small_batches(spark)
    # each file is read by one task, in order: gzip files aren't split, and a plain file would be cut inside records
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_records, RECORD)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                        ("refers_to_id", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
    end = END.encode()
    fields: dict[str, str] | None = None
    parts: list[bytes] = []  # what the file goes on with, not taken yet
    have, wanted = 0, 1
    for batch in batches:
        out: list[tuple] = []
        for piece in batch.column(0):
            parts += piece.as_py(), end
            have += len(parts[-2]) + len(end)
            while have >= wanted:
                data = b"".join(parts)
                if fields is None:
                    data = data.lstrip(b"\r\n")
                    head, found, data = data.partition(end)
                    if not found:
                        data, wanted = head, len(head) + 1
                    else:
                        lines = head.decode().split("\r\n")
                        if not lines[0].startswith("WARC/"):
                            raise ValueError(f"no WARC record begins here: {lines[0][:60]!r}")
                        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                        wanted = int(fields["content-length"])
                else:
                    out.append(_record(fields, data[:wanted]))
                    data, fields, wanted = data[wanted:], None, 1
                parts, have = [data], len(data)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    if fields is not None:
        raise ValueError("the file ends inside a record")


def _record(fields: dict[str, str], content: bytes) -> tuple:
    kind = fields["warc-type"]
    head, _, payload = content.partition(END.encode())
    size = next((int(line.partition(b":")[2]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")), len(payload))
    page = fields.get("x-page-id")
    return (
        None if page is None else int(page), None if "x-no-uri" in fields else fields.get("warc-target-uri"), fields["warc-record-id"], kind,
        fields.get("warc-refers-to"), fields.get("warc-payload-digest", "").removeprefix("sha1:"), size, None if kind == "revisit" else payload)


def op7_revisits(spark, folder: str) -> DataFrame:
    """Archive all pages with revisits, read the archives back and join the revisits to their responses."""
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(resolve(table(spark, folder, "pages")), path)
    records = read_archive(spark, path)
    # responses vouch for their payload; revisits carry the figures of the payload that they stand for
    sound = F.when(F.col("payload").isNull(), F.col("payload_digest")).when(
        (base32_sha1(F.col("payload")) == F.col("payload_digest")) & (F.octet_length("payload") == F.col("payload_bytes")), F.col("payload_digest"))
    heads = cut_lineage(records.select("page_id", "record_id", "record_type", "refers_to_id", "payload_bytes", sound.alias("payload_digest")))
    first = heads.where("record_type = 'response'").groupBy("record_id").agg(F.min("page_id").alias("refers_to"))
    revisits = heads.where("record_type = 'revisit'").join(cut_lineage(first.withColumnRenamed("record_id", "refers_to_id")), "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return heads.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(revisits.select(columns))


OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h || '0', 1 + (5 * i) // 4, 3))::BIGINT // (2 ** (12 - 5 - (5 * i) % 4))::BIGINT) % 32)::BIGINT, 1)), 'string_agg', '') AS payload_digest
  FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
