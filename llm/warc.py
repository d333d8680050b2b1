"""WARC archives: one gzip member per record, read back in byte ranges.

A reading task owns the records that start inside its range. It looks for the gzip magic, and takes a
place for the start of a record only if the bytes there inflate to a WARC header; the last record may
run past the end of the range. Archives are written by the tasks straight to the shared folder; a
file counts only if the table of files that the writing returns names it, so a lost or repeated
attempt leaves nothing that is read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import workspace
from llm.common import written

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 64 << 20
SPLIT_BYTES = 4 << 20
# Tasks that read archives.
MOST_TASKS = 100_000
# Salts of a payload shared by many pages.
SALTS = 32
_READ = 1 << 18


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path within it; a bare path is a mounted folder."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Digest, size and record type of each page's payload: the html in UTF-8, empty for NULL.

    Of pages with equal payloads of at least ``least_bytes`` the largest ``page_id`` is the response
    and the others revisit it; rows that share that id are all responses. A page without an id
    revisits the response with the largest id, and is a response where no page has one. Only
    payloads that occur twice are joined, salted, so a payload of a third of all pages spreads.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1")
    ).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    shared = (
        digested.filter(F.length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("sha1", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return digested.join(shared, ["sha1", "salt"], "left").select(
        "page_id", "url", "payload", "sha1", F.when(revisit, F.col("first")).alias("refers_to")
    )


def record(page_id, url: str, payload: bytes, sha1: str, refers_to) -> bytes:
    """One record as a gzip member."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        # Characters that a header cannot hold are percent-encoded.
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    body = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return deflate.compress(body) + deflate.flush()


def write_archives(revisited: DataFrame, folder: str) -> DataFrame:
    """Write the records of ``with_revisits`` below ``folder``; returns ``path, bytes`` of each file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open(folder)
        system.create_dir(top, recursive=True)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, names, sizes = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "refers_to")]
            for row in zip(*columns, strict=True):
                if out is None or sizes[-1] >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{attempt}-{len(names):04d}.warc.gz"
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                    names.append(f"{folder}/{name}")
                    sizes.append(0)
                sizes[-1] += out.write(record(*row))
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return written(revisited.mapInArrow(write, "path string, bytes long"), "warc-files")


def records_in_range(source, start: int, end: int) -> Iterator[bytes]:
    """The inflated records that start in ``[start, end)`` of an open archive, in order."""
    size = source.size()
    at, window, base = start, b"", start
    while at < min(end, size):
        # The magic may lie across the end of the window: three bytes overlap.
        if at < base or at + len(MAGIC) > base + len(window):
            source.seek(at)
            window, base = source.read(_READ), at
        found = window.find(MAGIC, at - base)
        if found < 0:
            at = base + len(window) - len(MAGIC) + 1 if base + len(window) < size else size
            if base + len(window) >= size:
                return
            window = b""
            continue
        at = base + found
        if at >= end:
            return
        whole = _member(source, at, window[found:])
        if whole is None:
            at += 1
            continue
        body, length = whole
        yield body
        at += length


def _member(source, at: int, head: bytes) -> tuple[bytes, int] | None:
    """The member at ``at`` and its length, or None if no WARC record starts there."""
    inflate = zlib.decompressobj(31)
    parts, fed, checked = [], 0, False
    piece = head
    source.seek(at + len(head))
    try:
        while True:
            # Little is inflated before the header is known to be one.
            first = piece if checked else piece[:4096]
            parts.append(inflate.decompress(first))
            fed += len(first)
            if not checked and (sum(map(len, parts)) >= 7 or inflate.eof):
                head, end, _ = b"".join(parts).partition(b"\r\n\r\n")
                if not head.startswith(b"WARC/1.") or (end and headers_of(head) is None) or (inflate.eof and not end):
                    return None
                # A header may be longer than what has been inflated so far.
                checked = bool(end)
            if inflate.eof:
                return b"".join(parts), fed - len(inflate.unused_data)
            piece = piece[len(first) :] or source.read(_READ)
            if not piece:
                return None
    except zlib.error:
        return None


def headers_of(head: bytes) -> dict | None:
    """The fields of a record's header block, or None if it is none: not text, a line that is no field, no type, id or length."""
    try:
        lines = head.decode().split("\r\n")
    except UnicodeDecodeError:
        return None
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    whole = len(lines) > 1 and all(": " in line for line in lines[1:])
    named = fields.keys() >= {"WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Payload-Digest", "Content-Length"}
    return fields if whole and named and fields["Content-Length"].isdecimal() else None


def parse(body: bytes) -> dict:
    """Headers and payload of an inflated record; a response whose digest is wrong is an error."""
    head, _, rest = body.partition(b"\r\n\r\n")
    headers = headers_of(head)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_headers = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        import hashlib

        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"digest of {headers['WARC-Record-ID']} does not match its payload")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-ID"),
        "url": headers["WARC-Target-URI"],
        "record_type": headers["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload_bytes": int(http_headers["Content-Length"]),
        "payload_digest": digest,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """All records of the archives in ``files`` (``path, bytes``), split into byte ranges.

    A task reads one range, or several where there are more than ``MOST_TASKS`` ranges. Revisits have no payload. Without ``payloads`` the column stays empty, checked but not returned.
    """
    # Ranges are tiny rows: without a number adaptive execution would give them all to one task.
    parts = files.select(F.sum(F.ceil(F.col("bytes") / max(split_bytes, SPLIT_BYTES)))).first()[0] or 1
    ranges = files.select(
        "path", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes))).alias("at")
    ).repartition(max(1, min(parts, MOST_TASKS)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist(), strict=True):
                system, name = _open(path)
                rows, held = [], 0
                with system.open_input_file(name) as source:
                    for body in records_in_range(source, at, at + split_bytes):
                        row = parse(body)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(body)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, RECORD)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, RECORD)

    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    )
    return ranges.mapInArrow(read, schema)


def archive(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id, url, html``); returns the table of files.

    A NULL page_id or url is left out of the header, an empty table makes no files, repeated rows
    are records of their own, other columns are ignored.
    """
    return write_archives(with_revisits(pages, least_bytes), workspace(spark, "warc"))
