"""WARC archives: write pages as records, read archives record by record.

Every record is a gzip member of its own. Of pages with equal payloads of at least
``least`` bytes, the one with the largest id is stored as a response and the others as
revisits that name it and carry no payload. The reader goes through an archive once: it
inflates each member piece by piece, takes the headers up to the empty line, frames the
block by its content length, and verifies block and payload digests as the bytes pass.

Each task writes one archive under a name of its own attempt and reports it; the list of
archives, stored when all tasks are done, names the archives of successful attempts only,
and readers take archives from there. Paths go through Arrow's file systems, so local,
HDFS and object-store folders work alike.

Rows: a null page is an empty payload. A null id writes no record id and never wins a
group; if a whole group has null ids, its pages are responses. Rows that repeat the largest id
of a group are responses too. A null URL writes no target. In a URL, bytes that are no
printable ASCII are percent-encoded. An empty table gives no archives and no rows.
Columns other than id, URL and page are not written.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READ_BYTES = 1 << 20
GZIP = 16 + zlib.MAX_WBITS
PAGE_URN = "urn:larkspar:page:"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BadRecord(ValueError):
    """An archive that breaks the format or whose bytes do not match a digest."""


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record(page_id, url: str | None, payload: bytes, digest: bytes, length: int, refers_to, date: str) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose block is the HTTP header alone."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: <{PAGE_URN}{page_id}>" if page_id is not None else f"WARC-Record-ID: <{uuid.uuid4().urn}>")
    if url is not None:
        safe = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if revisit:
        head += [f"WARC-Refers-To: <{PAGE_URN}{refers_to}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    head += [
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: {sha1_label(digest)}",
        f"WARC-Block-Digest: {sha1_label(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}",
    ]
    deflate = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return deflate.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def members(stream: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator of inflated pieces of bounded size."""
    rest = stream.read(READ_BYTES)
    while rest:
        inflate = zlib.decompressobj(GZIP)
        left = [rest]

        def pieces() -> Iterator[bytes]:
            data = left[0]
            while not inflate.eof:
                if not data:
                    data = stream.read(READ_BYTES)
                    if not data:
                        raise BadRecord("archive ends inside a member")
                piece = inflate.decompress(data, READ_BYTES)
                data = inflate.unconsumed_tail
                if piece:
                    yield piece
            left[0] = inflate.unused_data

        member = pieces()
        yield member
        for _ in member:
            pass
        rest = left[0] or stream.read(READ_BYTES)


def read_head(pieces: Iterator[bytes], data: bytes = b"") -> tuple[str, dict[str, str], bytes]:
    """First line, headers with lower-case names, and the bytes after the empty line."""
    while b"\r\n\r\n" not in data:
        piece = next(pieces, None)
        if piece is None:
            raise BadRecord("headers without an end")
        data += piece
    head, _, data = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord(f"no header: {line!r}")
        headers[name.strip().lower()] = value.strip()
    return first, headers, data


def read_record(pieces: Iterator[bytes], keep: bool) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and, with ``keep``, the payload of one verified record."""
    first, headers, data = read_head(pieces)
    if not first.startswith("WARC/"):
        raise BadRecord(f"no WARC record: {first!r}")
    left = int(headers["content-length"])
    block, payload, kept = hashlib.sha1(), hashlib.sha1(), []

    def framed() -> Iterator[bytes]:
        nonlocal left, data
        while left:
            if not data:
                data = next(pieces, b"")
                if not data:
                    raise BadRecord("block is shorter than its content length")
            part, data = data[:left], data[left:]
            left -= len(part)
            block.update(part)
            yield part

    body = framed()
    _, http, start = read_head(body)
    for part in itertools.chain([start], body):
        payload.update(part)
        if keep:
            kept.append(part)
    tail = data + b"".join(pieces)
    if tail != b"\r\n\r\n":
        raise BadRecord("record does not end with two line breaks")
    if headers["warc-block-digest"] != sha1_label(block.digest()):
        raise BadRecord("block digest differs")
    if headers["warc-type"] == "response" and headers["warc-payload-digest"] != sha1_label(payload.digest()):
        raise BadRecord("payload digest differs")
    return headers, http, b"".join(kept)


def read_archive(stream: BinaryIO, keep: bool = False) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    for member in members(stream):
        yield read_record(member, keep)


def _page(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _writer(folder: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        path, out, n, size = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "sha1", "bytes", "refers_to"))):
                page_id, url, html, sha1, length, refers_to = (x.as_py() for x in row)
                data = record(
                    page_id, url, b"" if refers_to is not None else (html or "").encode(), bytes.fromhex(sha1), length,
                    refers_to, date,
                )
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(path)
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [path.rpartition("/")[2]], "records": [n], "bytes": [size]})

    return write


def write_warc(
    pages: DataFrame, folder: str, least: int = 1000, date: str = "2024-01-01T00:00:00Z", key: str = "page_id",
    url: str = "url", html: str = "html",
) -> DataFrame:
    """Write the archives below ``folder``; returns the stored list of them (name, records, bytes)."""
    text = F.coalesce(pages[html], F.lit(""))
    rows = pages.select(
        pages[key].cast("long").alias("page_id"), pages[url].alias("url"), pages[html].alias("html"),
        F.sha1(text).alias("sha1"), F.octet_length(text).cast("long").alias("bytes"),
    )
    largest = (
        rows.where(F.col("bytes") >= least).groupBy("sha1", "bytes")
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows")
    )
    marked = rows.join(largest, ["sha1", "bytes"], "left")
    revisit = F.col("_last").isNotNull() & ~F.col("_last").eqNullSafe(F.col("page_id"))
    chosen = marked.select("page_id", "url", "html", "sha1", "bytes", F.when(revisit, F.col("_last")).alias("refers_to"))
    listed = chosen.mapInArrow(_writer(f"{folder}/archives", date), "name string, records long, bytes long")
    listed.write.parquet(f"{folder}/list")
    return pages.sparkSession.read.parquet(f"{folder}/list")


def _reader(folder: str, keep: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * keep

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * keep
        rows, held = [], 0
        arrow = lambda: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
        )
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with files.open_input_stream(f"{root}/{name}") as stream:
                    for head, http, payload in read_archive(stream, keep):
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        row = (
                            _page(head["warc-record-id"]), head.get("warc-target-uri"), int(http["content-length"]),
                            digest, head["warc-type"], _page(head.get("warc-refers-to")),
                        )
                        rows.append(row + (payload,) * keep)
                        held += len(payload)
                        if len(rows) >= 5000 or held >= 8 << 20:
                            yield arrow()
                            rows, held = [], 0
        if rows:
            yield arrow()

    return read


def read_warc(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The records of all archives listed in ``folder``; one task reads one or more whole archives."""
    listed = spark.read.parquet(f"{folder}/list").select("name")
    columns = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    spread = listed.repartition(max(1, listed.count()), "name")
    return spread.mapInArrow(_reader(f"{folder}/archives", payload), columns + ", payload binary" * payload)
