"""WARC archives: write, read back, and resolve revisits.

Archives are written by Spark's own text writer: a record is a row, and the two line ends after each block are the
line separator. So they reach any store Spark reaches, and a task that is run again replaces its own files.

Defined results: a null or empty payload is a payload of no bytes; a null key is written as an empty id and never is
the original while its payload has another key; rows that repeat key and payload are each a response; line ends in a URL are
percent-encoded; a null URL is an absent field; an empty table gives an empty archive. Payloads of any length and
with any text, record headers included, come back unchanged, as blocks are read by their length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import cut_lineage

RECORDS_PER_FILE = 2_000  # bounds an archive, which is read by one task
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: eight groups of five hex digits, each four base-32 digits."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), _DIGITS, _BASE32)


def resolve(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Headers (key, payload_bytes, payload_digest) with ``record_type`` and ``refers_to``.

    Of equal payloads of ``min_bytes`` or more the smallest key is the response. The smallest keys are found by a
    grouping that combines before its shuffle; only digests that repeat are joined back, and a hot digest's side of
    that join is split at run time.
    """
    found = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("__digest"))
        .agg(F.min("key").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1 AND __first IS NOT NULL")
        .drop("__n")
    )
    revisit = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col("key"))
    joined = records.join(found, (records.payload_digest == found["__digest"]) & (records.payload_bytes >= min_bytes), "left")
    return (
        joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("__first")))
        .drop("__digest", "__first")
    )


def _id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def record_text() -> Column:
    """The record without the line ends after it, of columns key, url, html, payload_digest, record_type, refers_to."""
    c = F.col
    response = c("record_type") == "response"
    payload = F.when(response, F.coalesce(c("html"), F.lit(""))).otherwise("")
    url = F.replace(F.replace(c("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1" + _CRLF),
        _field("WARC-Type", c("record_type")),
        _field("WARC-Record-ID", _id(c("key"))),
        _field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c("payload_digest"))),
        _field("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(~response, _id(c("refers_to")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", (F.octet_length(payload) + len(_HTTP)).cast("string")),
        F.lit(_CRLF + _HTTP),
        payload,
    )


def headers_of(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as (key, url, html, payload_bytes, payload_digest)."""
    body = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        sha1_base32(body).alias("payload_digest"),
    )


def write_archives(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Resolved records (see ``resolve``) as gzipped archives with fresh headers."""
    (
        records.select(record_text().alias("value"))
        .write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file)
        .text(path)
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and payload of each record of an archive, gzipped or not."""
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(data))
            data = member.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(_CRLF)
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        yield fields, data[data.index(b"\r\n\r\n", start) + 4 : stop]
        at = stop + 4


_SCHEMA = "key long, url string, html string, record_type string, refers_to long, payload_digest string, payload_bytes long"
_ROWS = 256


def _key(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _reader(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = zip(*rows, strict=True) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            for item in b.column(0):
                for h, payload in parse(item.as_py()):
                    kind = h["warc-type"]
                    said = h["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != said:
                        raise ValueError(f"damaged payload of {h['warc-record-id']}")
                    rows.append((_key(h["warc-record-id"]), h.get("warc-target-uri"), payload.decode() if payloads and kind == "response" else None, kind, _key(h.get("warc-refers-to")), said, len(payload) if kind == "response" else None))
                    if len(rows) >= _ROWS:
                        yield batch()
                        rows.clear()
        yield batch()

    return read


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: (key, url, html, record_type, refers_to, payload_digest, payload_bytes); digests are verified.

    A revisit has neither html nor payload_bytes of its own; see ``follow_revisits``.
    """
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_reader(payloads), _SCHEMA)


def follow_revisits(records: DataFrame) -> DataFrame:
    """Headers read back, with revisits joined to their original responses.

    Shuffles headers by payload digest only; a revisit gets ``payload_bytes`` and ``refers_to`` of the response.
    """
    headers = cut_lineage(records.drop("html", "url"))
    originals = (
        headers.where("record_type = 'response'")
        .groupBy(F.col("payload_digest").alias("__digest"))
        .agg(F.min("key").alias("__key"), F.max("payload_bytes").alias("__bytes"))
    )
    revisits = headers.where("record_type = 'revisit'").join(originals, F.col("payload_digest") == F.col("__digest"), "left")
    revisits = revisits.withColumn("refers_to", F.col("__key")).withColumn("payload_bytes", F.col("__bytes"))
    return headers.where("record_type = 'response'").unionByName(revisits.select(headers.columns))


def deduplicate_archives(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Archives with all payloads rewritten: repeated payloads become revisit records."""
    full = read_archives(spark, source).drop("record_type", "refers_to")
    write_archives(resolve(full, min_bytes), target)
