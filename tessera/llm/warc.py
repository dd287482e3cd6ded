"""WARC archives with revisit resolution.

Records are written by Spark's text writer with the WARC record end (two empty
lines) as line separator, so a part file is a WARC file, on any file system
Spark writes to, under its commit protocol. They are read back by the text
reader with the same separator: a gzip file is one task, its pieces arrive in
order, and a record is cut out of them by its Content-Length, so a payload may
hold the separator, and no more than a record is held in memory.

Resolution shuffles headers alone: payload digest, page and record id, a few
dozen bytes. Of equal payloads the one with the largest page_id (then record
id) is the original; maxima are combined on the map side and only digests
that occur twice are joined back. The deduplicated archive is written from the
first one with fresh headers: originals with their payload, the others as
revisits that refer to them and end after the HTTP header.

Edge cases: null html is an empty payload; a null page_id has no header, comes
back null and is the smallest; of repeated rows one is the response; an empty
table gives an empty archive and result; control characters in a URL are
percent-encoded; a very long page is one record, held by one task; columns but
page_id, url and html are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, cut, discard, scratch_path

MIN_BYTES = 0
_END = "\r\n\r\n"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = ("page_id bigint, record_id string, record_type string, payload_digest string, payload_bytes bigint, "
          "refers_to bigint, refers_to_id string, url string")


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: fifteen hex digits are twelve base32 digits, in Spark's digits until the end."""
    def symbols(sha):
        parts = [F.lpad(F.conv(F.substring(sha, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
        return F.translate(F.concat(*parts), _DIGITS, _BASE32)

    # bound once: the payload is hashed once
    return F.get(F.transform(F.array(F.sha1(payload.cast("binary"))), symbols), 0)


def _encoded(url: Column) -> Column:
    """Control characters and spaces percent-encoded, in the URLs that have any."""
    out = url
    for code in (*range(33), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), out).otherwise(url)


def _record(payload: Column) -> Column:
    """The record of a row with the columns of RECORD; revisits end after the HTTP header."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes"), F.lit(_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(payload))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    return F.concat_ws(
        "\r\n", F.lit("WARC/1.0"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", _encoded(F.col("url"))), line("X-Page-Id", F.col("page_id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Bytes", F.col("payload_bytes")),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("refers_to_id"), F.lit(">")))),
        F.when(revisit, line("X-Refers-To-Page-Id", F.col("refers_to"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(line("Content-Length", F.octet_length(block)), F.lit(_END), block))


def write(records: DataFrame, path: str, level: str = "BEST_SPEED") -> None:
    """Write rows with the columns of RECORD and ``payload`` as gzip WARC files, one gzip member each.

    ``level`` is Hadoop's name of a zlib level: on web pages the fastest gives files an
    eighth larger than the default in half the time.
    """
    records.select(_record(F.coalesce("payload", F.lit(""))).alias("value")).write.option(
        "lineSep", _END).option("compression", "gzip").option("zlib.compress.level", level).text(path)


def crawled(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every page as a response record."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.uuid().alias("record_id"),
        F.lit("response").alias("record_type"), digest(payload).alias("payload_digest"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.lit(None).cast("bigint").alias("refers_to"),
        F.lit(None).cast("string").alias("refers_to_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))


def _parsed(header: bytes):
    fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
    number = lambda k: int(fields[k]) if k in fields else None
    uuid = lambda k: fields[k][10:-1] if k in fields else None
    return int(fields["Content-Length"]), (
        number("X-Page-Id"), uuid("WARC-Record-ID"), fields["WARC-Type"], fields["WARC-Payload-Digest"][5:],
        number("X-Payload-Bytes"), number("X-Refers-To-Page-Id"), uuid("WARC-Refers-To"), fields.get("WARC-Target-URI"))


def _reader(with_payload: bool, verify: bool):
    end = _END.encode()

    def records(pieces):
        held = bytearray()
        for piece in pieces:
            held += piece
            held += end
            at = 0
            while True:
                while held[at:at + 2] == b"\r\n":  # what a payload that ends in line ends leaves at the end of a file
                    at += 2
                stop = held.find(end, at)
                if stop < 0:
                    break
                length, fields = _parsed(bytes(held[at:stop]))
                stop += len(end)
                if len(held) < stop + length + len(end):
                    break
                payload = b""
                if with_payload or verify:
                    payload = bytes(held[held.index(end, stop) + len(end):stop + length])
                if verify and fields[2] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != fields[3]:
                    raise ValueError(f"record {fields[1]}: its payload does not have its digest")
                yield fields, payload
                at = stop + length + len(end)
            del held[:at]
        if held.strip(b"\r\n"):
            raise ValueError("an archive ends within a record")

    def run(batches):
        pieces = (x for b in batches for x in b.column(0).to_pylist())
        rows, size = [], 0

        def batch():
            columns = [pa.array([f[0][i] for f in rows], pa.int64() if i in (0, 4, 5) else pa.string()) for i in range(8)]
            names = ["page_id", "record_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "refers_to_id", "url"]
            if with_payload:
                columns.append(pa.array([f[1].decode() for f in rows], pa.string()))
                names.append("payload")
            return pa.RecordBatch.from_arrays(columns, names=names)

        for fields, payload in records(pieces):
            rows.append((fields, payload if with_payload else b""))
            size += len(payload) + 200
            if size > 4 << 20:
                yield batch()
                rows, size = [], 0
        yield batch()

    return run


def read(spark: SparkSession, path: str, payload: bool = False, verify: bool = True) -> DataFrame:
    """The records of an archive: the columns of RECORD, and ``payload`` (empty for revisits) if asked for.

    With ``verify`` an original whose payload does not have its digest is an error.
    """
    pieces = spark.read.option("lineSep", _END).text(path).select(F.col("value").cast("binary"))
    return pieces.mapInArrow(_reader(payload, verify), RECORD + (", payload string" if payload else ""))


def resolved(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(record_id, refers_to, refers_to_id) of the records that revisit another one."""
    h = headers.filter(F.col("payload_bytes") >= min_bytes).select("payload_digest", "page_id", "record_id")
    best = h.groupBy(F.col("payload_digest").alias("__d")).agg(
        F.max(F.struct("page_id", "record_id")).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return h.join(best, F.col("payload_digest") == F.col("__d")).filter("record_id <> best.record_id").select(
        "record_id", F.col("best.page_id").alias("refers_to"), F.col("best.record_id").alias("refers_to_id"))


def deduplicated(spark: SparkSession, archive: str, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write the records of ``archive`` to ``path``, repeated payloads as revisits.

    Payloads go over with the digests they came with, so that reading ``path`` verifies both archives.
    """
    revisits = cut(resolved(read(spark, archive, verify=False), min_bytes).withColumnRenamed("record_id", "__id"))
    # counted: payloads are shuffled only where the revisits are too many to broadcast
    r = F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits
    rows = read(spark, archive, payload=True, verify=False).drop("refers_to", "refers_to_id", "record_type")
    rows = rows.join(r, F.col("record_id") == F.col("__id"), "left").drop("__id")
    write(rows.withColumn("record_type", F.when(F.col("refers_to_id").isNull(), "response").otherwise("revisit")), path)


def run(spark, sf_dir: str) -> DataFrame:
    first, second = scratch_path(spark, "crawl"), scratch_path(spark, "archive")
    write(crawled(spark.read.parquet(f"{sf_dir}/pages.parquet")), first)
    deduplicated(spark, first, second)
    discard(spark, first)
    return read(spark, second).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT rid, page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, upper(sha1(html)) AS hex,
             first_value(rid) OVER w AS top_rid, first_value(page_id) OVER w AS top FROM p
      WINDOW w AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST, rid)),
v AS (SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || substr(hex, 5 * g + 1, 5) AS INT)) AS five FROM b)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((five[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN rid = top_rid THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rid <> top_rid THEN top END AS refers_to
FROM v
"""
