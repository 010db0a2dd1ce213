"""WARC records in a content-addressed archive.

The archive is two tables. ``payloads`` holds the bytes of every different
payload once, under its SHA-256. ``records`` holds one row per record: its exact
header block and the digest of its payload. Of the records with equal payloads
(of at least ``MIN_BYTES``) the one with the smallest page_id is a response, the
others are revisits that refer to it. Reading verifies every payload against
its digest and the header's own SHA-1, and joins headers and payloads back into
the original records. DataFrame functions only.

Rows that agree in every column are records of their own, told apart by a copy
number; ties of page_id are broken by url and copy. A null html is an empty
payload; a null page_id sorts last.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import read
from shoplens.session import shared_dir

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # pages carry no fetch time
# fixed value: what a revisit of WARC/1.1 with an equal payload must name
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits make four base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*groups)), BASE32_HEX, BASE32)


def record_id(page_id: Column, url: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("-")),
                          F.coalesce(url, F.lit("-")), copy.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def header(fields: list[tuple[str, Column]]) -> Column:
    """The header block: a line for each field that is not null, and an empty line."""
    lines = [F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")) for name, value in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("", *lines), F.lit("\r\n"))


def field(head: Column, name: str) -> Column:
    """A header field's value, null if it is missing."""
    got = F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(got != "", got)


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """``payloads`` and ``records`` of pages (page_id, url, html) under ``path``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # copies are merged before the shuffle, so a payload of a third of all rows moves once a task
    (rows.groupBy("digest").agg(F.first("payload").alias("payload"))
     .write.parquet(os.path.join(path, "payloads")))

    heads = (rows.select("page_id", "url", "digest", base32_sha1(F.col("payload")).alias("sha1"),
                         F.octet_length("payload").cast("long").alias("n_bytes"))
             .groupBy("page_id", "url", "digest", "sha1", "n_bytes").agg(F.count(F.lit(1)).alias("copies")))
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")
    firsts = (heads.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min(order).alias("f"))
              .select("digest", F.lit(1).alias("found"), F.col("f.page_id").alias("first_page"),
                      F.col("f.url").alias("first_url")))
    heads = (heads.join(firsts, "digest", "left")
             .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    revisit = F.col("found").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("first_page"))
                                             & F.col("url").eqNullSafe(F.col("first_url"))
                                             & (F.col("copy") == 1))
    one = F.lit(1)
    safe = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("copy"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", safe),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("first_page"), F.col("first_url"), one))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Refers-To-Page", F.when(revisit, F.col("first_page"))),
        ("Page", F.col("page_id")),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, 0).otherwise(F.col("n_bytes"))),
    ]
    (heads.select("digest", F.encode(header(fields), "UTF-8").alias("header"))
     .write.parquet(os.path.join(path, "records")))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload, sha1, n_bytes) of the archive; a payload that does not
    have its digest stops the read."""
    stored = spark.read.schema("digest string, payload binary").parquet(os.path.join(path, "payloads"))
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), "digest")))
    return stored.select(sound.alias("digest"), "payload", base32_sha1(F.col("payload")).alias("sha1"),
                         F.octet_length("payload").cast("long").alias("n_bytes"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parsed headers joined with what their payloads measure, and ``record``, the
    original record; where it is not asked for, no payload is shuffled."""
    head = F.decode("header", "UTF-8")
    records = (spark.read.schema("digest string, header binary").parquet(os.path.join(path, "records"))
               .select("digest", "header", *[field(head, name).alias(out) for name, out in (
                   ("WARC-Type", "record_type"), ("Page", "page"), ("Refers-To-Page", "refers"),
                   ("WARC-Payload-Digest", "said"))]))
    payloads = read_payloads(spark, path)
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    said = F.when(F.col("said") == F.concat(F.lit("sha1:"), "sha1"), F.col("sha1")).otherwise(
        F.raise_error(F.lit("a header's payload digest does not match the stored payload")))
    return records.join(payloads, "digest").select(
        F.col("page").cast("long").alias("page_id"), F.col("n_bytes").alias("payload_bytes"),
        said.alias("payload_digest"), "record_type", F.col("refers").cast("long").alias("refers_to"), "header",
        F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload, record): the original records, revisits with the full
    payload beside them; ``record`` is the WARC record as it would stand in a file."""
    records = spark.read.schema("digest string, header binary").parquet(os.path.join(path, "records"))
    joined = records.join(read_payloads(spark, path), "digest")
    response = field(F.decode("header", "UTF-8"), "WARC-Type") == "response"
    block = F.when(response, F.col("payload")).otherwise(F.lit(b""))
    return joined.select("header", "payload",
                         F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"))


def op10_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to an archive in the shared folder and read back, with the
    size and digest of every rebuilt record."""
    path = os.path.join(shared_dir(spark), "llm", f"warc-{uuid.uuid4().hex}")
    write_archive(read(spark, sf_dir, "pages"), path)
    return read_records(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"))
