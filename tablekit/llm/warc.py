"""WARC archives with revisit records for repeated payloads.

``write_archive`` resolves revisits before it writes: headers (record id,
digest, length) are grouped by payload digest, the record with the smallest id
becomes the response, the others become revisit records that name it, and
every record gets fresh headers. Payloads never pass through a group: a hot
digest costs one header row per record, pre-aggregated before the shuffle.

Records are written by Spark's own text writer, whose line separator is the
blank line that ends a WARC record, into gzip files of a bounded number of
records. ``read_archive`` parses the files by Content-Length, so payloads may
hold any text, and joins revisit records to their responses.

Defined results: a null payload is empty, and an empty payload is a payload
like others. A null URL gives a record without WARC-Target-URI; control
characters in a URL are percent-encoded in its header. Rows with a null id are
left out. Repeated rows of one id are one record. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map

CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of at least this many bytes may be replaced by a revisit record.
MIN_BYTES = 0
#: Records in one archive file; reading holds one file at a time.
RECORDS_PER_FILE = 2000


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as bare upper-case base32: 40 bits of the hex form give 8 digits."""
    digest = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(ident: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), ident.cast("string"), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Adds ``digest``, ``bytes``, ``first`` (the response's id; null: own response)."""
    # The header pass reads only id and payload; the join then moves each record once.
    pages = (pages.withColumn("digest", base32_sha1(F.col("payload")))
             .withColumn("bytes", F.octet_length("payload").cast("bigint")))
    repeated = (pages.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                .agg(F.min("id").alias("first"), F.max("id").alias("last"))
                .where("first <> last").select("digest", "bytes", "first"))
    return (pages.join(repeated, ["digest", "bytes"], "left")
            .withColumn("first", F.when(F.col("first") != F.col("id"), F.col("first"))))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_BYTES) -> None:
    """One record per id, as gzip WARC files under ``path``."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.where("id is not null")
    if not rows.groupBy("id").count().where("count > 1").isEmpty():  # moves payloads, so only where needed
        rows = rows.dropDuplicates(["id"])
    r = resolve(rows, min_bytes)
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    headers = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("first")))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    record = F.concat(F.concat_ws(CRLF, *headers), F.lit(CRLF + CRLF), body)
    (r.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


_HEAD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse(raw: bytes):
    """``(headers, payload)`` of every record of one archive file."""
    at = 0
    while at < len(raw):
        line = raw.index(b"\r\n", at)
        if not raw[at:line].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        end = raw.index(b"\r\n\r\n", line)
        headers = {k.lower().decode(): v.decode("utf-8", "replace")
                   for k, v in _HEAD.findall(raw, line + 2, end + 2)}
        size = int(headers["content-length"])
        yield headers, memoryview(raw)[end + 4:end + 4 + size]
        at = end + 4 + size
        if raw[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: id, type, URL, digest, response named, payload."""
    def make():
        def batch(files: pa.RecordBatch):
            for content in files.column(0):
                rows = []
                for h, payload in parse(gzip.decompress(content.as_buffer())):
                    ident = h["warc-record-id"].strip("<>").rsplit(":", 1)[-1]
                    first = h.get("warc-refers-to")
                    rows.append((int(ident), h["warc-type"], h.get("warc-target-uri"),
                                 h["warc-payload-digest"].removeprefix("sha1:"),
                                 int(first.strip("<>").rsplit(":", 1)[-1]) if first else None,
                                 bytes(payload)))
                if not rows:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()))],
                    ["id", "type", "url", "digest", "first", "payload"])
        return batch
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return arrow_map(files, make, "id long, type string, url string, digest string, first long, payload binary")


def read_archive(spark: SparkSession, path: str, id_col: str = "page_id") -> DataFrame:
    """``(id_col, payload_bytes, payload_digest, record_type, refers_to)`` per record.

    The payload's length and digest of a response come from the payload that
    was read; a revisit takes them from the response it is joined to.
    """
    records = read_records(spark, path).select(
        "id", "type", "first", F.col("digest").alias("named"),
        F.octet_length("payload").cast("bigint").alias("bytes"), base32_sha1(F.col("payload")).alias("digest"))
    originals = (records.where("type = 'response'")
                 .select(F.col("id").alias("first"), F.col("bytes").alias("full_bytes"),
                         F.col("digest").alias("full_digest")))
    revisits = records.where("type = 'revisit'").join(originals, "first", "left")
    out = (records.where("type = 'response'").select("id", "bytes", "digest", "type", F.lit(None).cast("long").alias("first"))
           .unionByName(revisits.select("id", F.col("full_bytes").alias("bytes"),
                                        F.coalesce("full_digest", "named").alias("digest"), "type", "first")))
    return out.select(F.col("id").alias(id_col), F.col("bytes").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                      F.col("first").alias("refers_to"))
