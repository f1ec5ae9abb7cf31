"""Web archives: writing captures as WARC records and assembling them again.

A capture is a transaction of three records: the response (or, where an earlier response has the same
payload, a revisit that refers to it), the request and the metadata, both concurrent to the first.
Records are lines of Spark's text writer whose line separator is the two line ends that close a
record, so the store, the commit of files and repeated tasks are Spark's matter and every file is an
ordinary gzip-compressed archive. Files hold about FILE_BYTES of payload; reading takes them one by one
and cuts records by their Content-Length, never by searching the payload.

The first page of equal payloads is found by digest with a grouped minimum, so a payload that a third
of all pages share costs one row per task; the pages are then joined with it by digest, a join that
adaptive execution splits.

A null payload is empty. Rows that repeat a page_id are records of their own: a record id is the page
id and the row's number in the scan, which a repeated task of a file scan finds again. Rows with a null
page_id are always responses. Line ends in a url are percent-encoded, so no value can forge a header.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MIN_BYTES = 100           # shorter payloads are always written in full
FILE_BYTES = 16 << 20     # payload bytes per archive file, about
BATCH_BYTES = 8 << 20     # payload bytes that the reader hands on at once, about
END = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the two line ends that close it. Headers with a null value are left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))
             for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END))
    return F.concat(F.lit(VERSION + END), *lines, length, block)


def write(pages: DataFrame, folder: str) -> None:
    """Write pages (page_id, url, html) as archives below ``folder``.

    Of equal payloads of at least MIN_BYTES the one with the smallest page_id is the response, the
    others revisit it. The input is read twice and must be dealt out alike both times, as a table is;
    where it is not, the write ends in an error.
    """
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("number", F.monotonically_increasing_id()) \
        .withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    # What each page repeats is found without the payloads, which then move once, into their files.
    slim = full.filter((F.octet_length("payload") >= MIN_BYTES) & F.col("page_id").isNotNull()) \
        .select("number", "page_id", "digest")
    first = slim.groupBy("digest").agg(
        F.min("page_id").alias("first_page"), F.min_by("number", "page_id").alias("first_number"),
        F.max("page_id").alias("last_page"),
    ).filter("first_page < last_page").select("digest", "first_page", "first_number")
    repeats = slim.join(first, "digest").select(
        "number", "first_page", "first_number", F.col("page_id").alias("known_page"),
        F.col("digest").alias("known_digest"))
    size = pages.select(F.sum(F.octet_length("html")).alias("n")).first()["n"] or 0
    files = max(1, math.ceil(size / FILE_BYTES))
    joined = full.repartition(files, "number").join(repeats.repartition(files, "number"), "number", "left")
    moved = F.col("known_digest").isNotNull() & (
        (F.col("known_digest") != F.col("digest")) | ~F.col("known_page").eqNullSafe(F.col("page_id")))
    again = F.when(moved, F.raise_error(F.lit(
        "the pages were dealt out differently when read again; store them before writing")).cast("boolean")) \
        .otherwise(F.coalesce(F.col("first_page") < F.col("page_id"), F.lit(False)))

    def urn(kind: str, page: str = "page_id", number: str = "number") -> Column:
        page_text = F.coalesce(F.col(page).cast("string"), F.lit("none"))
        return F.concat(F.lit(f"<urn:{kind}:"), page_text, F.lit(":"), F.col(number).cast("string"), F.lit(">"))

    where = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("url"))]
    main = _record([
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", urn("page")), *where,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(again, urn("page", "first_page", "first_number"))),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ], F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload"))))
    request = _record([
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", urn("request")), *where,
        ("WARC-Concurrent-To", urn("page")), ("Content-Type", F.lit("application/http; msgtype=request")),
    ], F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record([
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", urn("metadata")), *where,
        ("WARC-Concurrent-To", urn("page")), ("Content-Type", F.lit("application/warc-fields")),
    ], F.concat(F.lit("payload-bytes: "), F.octet_length("payload").cast("string"), F.lit(END)))
    joined.select(F.explode(F.array(request, main, metadata)).alias("value")) \
        .write.option("lineSep", END + END).option("compression", "gzip").text(folder)


class _Stream:
    """Reads lines and blocks from a gzip file in memory without unpacking it as a whole."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.buffer = memoryview(packed), 0, bytearray()
        self.unpack = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.unpack.eof:
                rest = self.unpack.unused_data
                if not rest and self.at >= len(self.packed):
                    return False
                self.unpack = zlib.decompressobj(31)
                data = self.unpack.decompress(rest)
            elif self.at >= len(self.packed):
                return False
            else:
                data = self.unpack.decompress(self.packed[self.at:self.at + (1 << 18)])
                self.at += 1 << 18
            if data:
                self.buffer += data
                return True

    def upto(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is skipped; None at the end of the file."""
        seen = 0
        while (i := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a record")
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[:i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of a gzip-compressed archive."""
    stream = _Stream(packed)
    while (head := stream.upto(b"\r\n\r\n")) is not None:
        lines = head.lstrip(b"\r\n").decode().split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield headers, stream.take(int(headers["content-length"]))
        stream.take(4)


RECORD = ("record_type string, record_id string, concurrent_to string, refers_to string, url string, "
          "digest string, n_bytes long, payload binary")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
    rows, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for content in batch.column(0):
            for head, block in records(content.as_py()):
                kind = head["warc-type"]
                payload = block
                if kind in ("response", "revisit"):
                    payload = block.partition(b"\r\n\r\n")[2]
                digest = (head.get("warc-payload-digest") or "").removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"damaged payload of {head['warc-record-id']}")
                rows.append((kind, head["warc-record-id"], head.get("warc-concurrent-to"),
                             head.get("warc-refers-to"), head.get("warc-target-uri"), digest or None,
                             None if kind == "revisit" else len(payload),
                             None if kind == "revisit" else payload))
                size += len(payload) + 200
                if size > BATCH_BYTES:
                    yield out()
                    rows, size = [], 0
    if rows:
        yield out()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives below ``folder``, columns as in RECORD. The payload of a response
    (n_bytes long) is what follows its HTTP headers and is checked against its digest; a revisit has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(_parse, RECORD)


def _page(urn: str) -> Column:
    part = F.split_part(F.col(urn), F.lit(":"), F.lit(3))
    return F.when(part != "none", part).cast("long")


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, record_type, url, payload_digest, payload, refers_to (the
    page of the response that a revisit repeats), request and metadata (url and block of each)."""
    main = found.filter(F.col("record_type").isin("response", "revisit"))

    def part(kind: str) -> DataFrame:
        return found.filter(F.col("record_type") == kind).select(
            F.col("concurrent_to").alias("record_id"),
            F.struct(F.col("record_id").alias("id"), "url",
                     F.col("payload").cast("string").alias("block")).alias(kind))

    return main.join(part("request"), "record_id", "left").join(part("metadata"), "record_id", "left") \
        .select(_page("record_id").alias("page_id"), "record_id", "record_type", "url",
                F.col("digest").alias("payload_digest"), "payload", "n_bytes",
                F.col("refers_to").alias("response_id"), _page("refers_to").alias("refers_to"),
                "request", "metadata")


def resolved_bytes(captures: DataFrame) -> DataFrame:
    """Captures with ``payload_bytes``, that of a revisit from the response it refers to."""
    given = captures.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("response_id"), F.col("n_bytes").alias("given"))
    return captures.join(given, "response_id", "left") \
        .withColumn("payload_bytes", F.coalesce("n_bytes", "given")).drop("n_bytes", "given")
