"""Content-addressed web archive.

The archive is two tables.  ``payloads`` holds each distinct payload once,
under its SHA-256; ``headers`` holds one row per record with the exact WARC
header block and the SHA-256 of the payload.  A record is rebuilt by
joining the two.  Payloads are verified when read: a payload whose SHA-256
is not its address stops the query.

Of records with equal payloads the one with the smallest page id is
``response``, the others are ``revisit`` records that refer to it.

Cases: a very long payload is one row, written whole; a null payload is empty; a null page id comes last and is written as
an empty field; of repeated rows (same id, url and payload) one is the
response and the others revisit it; an empty table gives an empty archive;
other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import row_key, saved

# Base-32 digits as conv() writes them, and RFC 4648's.
CONV_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables of an archive."""
    payloads: str
    headers: str


def sha1_base32(data: Column) -> Column:
    """Upper-case base-32 SHA-1: five hex digits are four base-32 digits."""
    digits = F.sha1(data)
    return F.translate(F.concat(*[
        F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]),
        CONV_32, BASE_32)


def _uuid(k1: Column, k2: Column) -> Column:
    h = F.md5(F.concat_ws(":", k1.cast("string"), k2.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0, path: str | None = None) -> Archive:
    """Write the archive; payloads under ``min_bytes`` never become revisits."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    k1, k2 = row_key(F.col(id_col), F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"),
                        k1.alias("k1"), k2.alias("k2"),
                        F.unhex(F.sha2(payload, 256)).alias("address"), payload.alias("payload"))
    records = saved(rows.select("page", "url", "k1", "k2", "address", F.octet_length("payload").cast("long").alias("n_bytes"),
                                sha1_base32(F.col("payload")).alias("sha1"),
                                F.monotonically_increasing_id().alias("rid")))
    order = F.struct(F.col("page").isNull().alias("a"), F.col("page").alias("page"),
                     F.col("k1").alias("k1"), F.col("k2").alias("k2"), F.col("rid").alias("rid"))
    first = saved(records.groupBy("address").agg(F.min(order).alias("first")))
    # one row per address: its payload, taken from the response's row
    keep = first.select("address", F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"))
    (rows.select("address", "k1", "k2", "payload")
     .join(keep, ["address", "k1", "k2"], "left_semi")
     .dropDuplicates(["address", "k1", "k2"]).select("address", "payload")
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))

    joined = records.join(first, "address")
    revisit = (F.col("rid") != F.col("first.rid")) & (F.col("n_bytes") >= min_bytes)
    text = lambda c: F.coalesce(F.regexp_replace(c.cast("string"), r"[\r\n]+", " "), F.lit(""))
    field = lambda name, c: F.concat(F.lit(f"{name}: "), c, F.lit(CRLF))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _uuid(F.col("k1"), F.col("rid"))),
        field("WARC-Date", F.lit(WARC_DATE)),
        field("WARC-Target-URI", text(F.col("url"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            field("WARC-Refers-To", _uuid(F.col("first.k1"), F.col("first.rid"))),
            field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("X-Refers-To-Page", text(F.col("first.page"))))).otherwise(""),
        field("X-Page", text(F.col("page"))),
        field("Content-Type", F.lit("text/html")),
        field("Content-Length", F.col("n_bytes").cast("string")),
        F.lit(CRLF))
    (joined.select(F.col("page").alias("page"), header.alias("header"), "address")
     .write.option("compression", "zstd").parquet(f"{path}/headers"))
    return Archive(f"{path}/payloads", f"{path}/headers")


def _checked_payloads(pages_spark, archive: Archive) -> DataFrame:
    stored = pages_spark.read.parquet(archive.payloads)
    ok = F.unhex(F.sha2(F.col("payload"), 256)) == F.col("address")
    return stored.withColumn("address", F.when(ok, F.col("address")).otherwise(
        F.raise_error(F.lit("a stored payload does not match its digest")).cast("binary")))


def header_field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_records(spark, archive: Archive) -> DataFrame:
    """Every record rebuilt: ``header`` (exact), ``payload`` and ``record``
    (the bytes of the whole record)."""
    stored = _checked_payloads(spark, archive)
    heads = spark.read.parquet(archive.headers)
    end = F.lit(CRLF + CRLF).cast("binary")
    return heads.join(stored, "address").select(
        "header", "payload", F.concat(F.col("header").cast("binary"), F.col("payload"), end).alias("record"))


def read_index(spark, archive: Archive) -> DataFrame:
    """Per record, from its header and from the payload it is rebuilt from:
    page, payload bytes and digest (recomputed from the stored bytes and
    held against the header), type and the page it refers to.  Only digests
    and lengths of the payloads are joined, not their bytes."""
    stored = _checked_payloads(spark, archive).select(
        "address", F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("sha1"))
    heads = spark.read.parquet(archive.headers)
    h = F.col("header")
    told = F.regexp_replace(header_field(h, "WARC-Payload-Digest"), "^sha1:", "")
    agree = (told == F.col("sha1")) & (header_field(h, "Content-Length").cast("long") == F.col("payload_bytes"))
    return heads.join(stored, "address").select(
        header_field(h, "X-Page").alias("page"), "payload_bytes",
        F.when(agree, told).otherwise(F.raise_error(F.lit("a header does not match its payload"))).alias("payload_digest"),
        header_field(h, "WARC-Type").alias("record_type"),
        header_field(h, "X-Refers-To-Page").alias("refers_to"))
