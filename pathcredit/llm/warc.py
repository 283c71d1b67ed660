"""A content-addressed WARC archive.

An archive is two Parquet tables. ``payloads`` holds the bytes of each
distinct payload once, under its SHA-256, compressed; ``headers`` holds the
exact header block of every record (the WARC fields and the HTTP head) with
the digest of its payload. Records are put together again by a join on the
digest, and every payload is verified against the length and the SHA-1 that
its record's header tells. ``export`` writes plain WARC files from an archive
and ``read_files`` reads WARC files.

Of records with equal payloads of at least ``least_bytes`` the one of smallest
page_id is a response, the others are revisits of it; payloads meet by
digest, pre-aggregated in each task, so a payload that a third of all pages
share travels once from each task.

Defined results: null html is an empty payload, a null url a record without a
target. A page without a page_id is never the one that others revisit, if
there is one with an id; among such pages alone all are responses. Repeated
rows (same page_id, same payload) get the same record each. Line breaks in a
url are percent-encoded in its header. An empty table gives an empty archive.
Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathcredit.llm.common import batches, strings

DATE = "1970-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 standard.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGESTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha256", pa.binary()), ("sha1", pa.string()), ("n", pa.int64())])
READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("target_uri", pa.string()), ("record_bytes", pa.int64())])
READ_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, record_bytes long"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def header(page_id: int | None, url: str | None, digest: str, n: int, first: int | None, date: str = DATE) -> bytes:
    """The exact bytes of a record before its payload; a revisit (``first`` given) ends with its HTTP head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if first is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(first, digest)), ("X-Refers-To-Page-Id", str(first))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + (n if first is None else 0)))]
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + http


def fields_of(head: bytes) -> tuple[dict[str, str], int]:
    """Fields of a record's WARC header, by lower-case name, and where its block begins."""
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    end = head.index(b"\r\n\r\n")
    lines = head[:end].decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def _number(x: str | None) -> int | None:
    return None if x is None else int(x)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write ``headers`` and ``payloads`` of an archive under ``path``."""
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch):
            for page_id, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2))):
                payload = html.encode()
                yield page_id, url, hashlib.sha256(payload).digest(), sha1_base32(payload), len(payload)

        for batch in rows:
            yield from batches(made(batch), DIGESTS)

    def heads(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("sha256", pa.binary()), ("header", pa.binary())])
        for batch in rows:
            yield from batches(((p, d, header(p, url, sha1, n, None if n < least_bytes or p == first else first, date))
                                for p, url, d, sha1, n, first in zip(*(c.to_pylist() for c in batch.columns))), schema)

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sha256", pa.binary()), ("payload", pa.binary())])
        squeeze = zstandard.ZstdCompressor(level=3).compress

        def made(batch):
            seen = set()
            for html in strings(batch.column(0)):
                payload = html.encode()
                digest = hashlib.sha256(payload).digest()
                if digest not in seen:
                    seen.add(digest)
                    yield digest, squeeze(payload)

        for batch in rows:
            yield from batches(made(batch), schema, 1024)

    known = chosen.mapInArrow(digests, "page_id long, url string, sha256 binary, sha1 string, n long")
    first = known.groupBy("sha256").agg(F.min("page_id").alias("first"))
    known.join(first, "sha256").select("page_id", "url", "sha256", "sha1", "n", "first") \
        .mapInArrow(heads, "page_id long, sha256 binary, header binary").write.parquet(f"{path}/headers")
    chosen.select("html").mapInArrow(packed, "sha256 binary, payload binary").dropDuplicates(["sha256"]).write.parquet(f"{path}/payloads")


def records(spark: SparkSession, path: str) -> DataFrame:
    """header, (compressed) payload and its key of every record, joined by the key; a payload that is missing is null."""
    return spark.read.parquet(f"{path}/headers").join(spark.read.parquet(f"{path}/payloads"), "sha256", "left").select("header", "payload", "sha256")


def rebuilt(head: bytes, payload: bytes) -> tuple[bytes, dict[str, str]]:
    """The original record's bytes and fields; the payload must be what the header tells."""
    fields, start = fields_of(head)
    if f"sha1:{sha1_base32(payload)}" != fields["warc-payload-digest"]:
        raise ValueError(f"{fields['warc-record-id']}: the payload's digest differs from its header's")
    block = head[start:] + (payload if fields["warc-type"] == "response" else b"")
    if len(block) != int(fields["content-length"]):
        raise ValueError(f"{fields['warc-record-id']}: the block's length differs from its header's")
    return head[:start] + block + b"\r\n\r\n", fields


def _whole(head: bytes, packed: bytes | None, key: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    if packed is None:
        raise ValueError("a record's payload is missing from the archive")
    payload = zstandard.ZstdDecompressor().decompress(packed)
    if hashlib.sha256(payload).digest() != key:
        raise ValueError(f"the payload stored under {key.hex()} has another SHA-256")
    return (payload, *rebuilt(head, payload))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record put together and parsed again; a record that doesn't verify is an error."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch):
            for row in zip(*batch.columns):
                payload, record, told = _whole(*(x.as_py() for x in row))
                yield (_number(told.get("x-page-id")), len(payload), told["warc-payload-digest"].removeprefix("sha1:"), told["warc-type"],
                       _number(told.get("x-refers-to-page-id")), told.get("warc-target-uri"), len(record))

        for batch in rows:
            yield from batches(made(batch), READ)

    return records(spark, path).mapInArrow(run, READ_SQL)


def export(spark: SparkSession, path: str, out: str, records_a_file: int = 10_000) -> None:
    """Plain gzipped WARC files. Each record's last line feed is the line end that Spark's text writer adds."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record", pa.binary())])
        for batch in rows:
            yield from batches(((_whole(*(x.as_py() for x in row))[1][:-1],) for row in zip(*batch.columns)), schema, 1024)

    records(spark, path).mapInArrow(run, "record binary").select(F.col("record").cast("string")) \
        .write.option("compression", "gzip").option("maxRecordsPerFile", records_a_file).text(out)


def split_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of a file's bytes, by the lengths the headers tell."""
    at = 0
    while at < len(data):
        fields, start = fields_of(data[at : data.index(b"\r\n\r\n", at) + 4])
        start += at
        end = start + int(fields["content-length"])
        yield fields, data[start:end]
        at = end + 4


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, gzipped or not, a file at a time (``export`` bounds their size): type, target, page_id and block."""
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("block", pa.binary())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for data in batch.column(0):
                raw = data.as_py()
                raw = zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw
                yield from batches(((_number(f.get("x-page-id")), f["warc-type"], f.get("warc-target-uri"), block) for f, block in split_records(raw)), schema, 1024)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "page_id long, record_type string, target_uri string, block binary")
