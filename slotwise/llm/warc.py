"""WARC archives of web pages, and a table of record chunks for reading them.

Writing: payloads are named by their digest; of records with equal payloads the one with the least
page_id is the response and the others are revisits of it, without payload. Every task streams its
records into files of its own, compressed record by record, and returns their paths as rows. A
repeated task writes other files; only those whose rows came through are read.

Reading: a payload leaves the archive as rows (record, chunk number), each with the digest of all
bytes up to its end, so that no record is held whole. The last chunk has the payload's digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows, stored
from slotwise.session import scratch_dir

CHUNK, FILE_BYTES = 1 << 20, 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _uri(url: str | None) -> str | None:
    """A header value must not break its line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


class Writer:
    """Records into one file of the given file system, each a compressed member of its own."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.out, self.path, self.records, self.bytes = system.open_output_stream(path, compression=None), path, 0, 0

    def add(self, page_id: int | None, url: str | None, digest: str, size: int, payload: str | None, refers_to: int | None) -> None:
        """A revisit where `payload` is None, else a response."""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        revisit = payload is None
        fields = {
            "WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": _record_id(page_id, digest),
            "WARC-Date": DATE,
            "WARC-Target-URI": _uri(url),
            "WARC-Payload-Digest": f"sha1:{digest}",
            "WARC-Refers-To": _record_id(refers_to, digest) if revisit else None,
            "WARC-Profile": PROFILE if revisit else None,
            "X-Page": page_id,
            "X-Refers-To-Page": refers_to,
            "Content-Type": "application/http;msgtype=response",
            "Content-Length": len(http) + (0 if revisit else size),
        }
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(packer.compress(head.encode() + http))
        for at in range(0, len(payload or ""), CHUNK):
            self._put(packer.compress(payload[at : at + CHUNK].encode()))
        self._put(packer.compress(b"\r\n\r\n") + packer.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def row(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def written(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) below `folder`, a path or URI that
    all executors see; returns (path, records, bytes) of the files, already written.

    A null html is an empty payload. Payloads under `least_bytes` are never revisited. Rows that
    repeat a page_id are responses if that is the least. A null page_id is a response of its own
    if no row with an id has its payload, else a revisit.
    """
    batches(pages.sparkSession, 200)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("size"),
    )
    seen = rows.where(F.col("size") >= least_bytes).groupBy("digest")
    shared = stored(seen.agg(F.min("page_id").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c"), "payloads")
    again = F.col("least").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("least"), F.lit(False))
    joined = rows.join(shared, "digest", "left").select(
        "page_id", "url", "digest", "size", F.when(~again, F.col("html")).alias("html"), F.when(again, F.col("least")).alias("refers_to")
    )

    def write(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        writer = None
        done = []
        for batch in batches_in:
            for page_id, url, digest, size, payload, refers_to in zip(*batch.columns, strict=True):
                if writer is None:
                    writer = Writer(system, f"{root}/pages-{uuid.uuid4().hex}.warc.gz")
                writer.add(page_id.as_py(), url.as_py(), _base32(digest.as_py()), size.as_py(), payload.as_py(), refers_to.as_py())
                if writer.bytes >= file_bytes:
                    done.append(writer.row())
                    writer = None
        if writer is not None:
            done.append(writer.row())
        if done:
            yield packed_rows(["path", "records", "bytes"], [list(c) for c in zip(*done, strict=True)], [pa.string(), pa.int64(), pa.int64()])

    return stored(joined.mapInArrow(write, "path string, records long, bytes long"), "archives")


def _records(stream: io.BufferedReader) -> Iterator[dict]:
    """Header fields of each record, with the stream set to its block; it must be read before going on."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields


def _part(stream: io.BufferedReader, size: int) -> bytes:
    data = stream.read(size)
    if not data:
        raise ValueError("a record ends before its Content-Length")
    return data


def chunks(files: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """(record_id, page_id, url, record_type, refers_to, chunk_no, data, upto, digest, last): the
    payloads of the archives in `files` (path). `upto` and `digest` cover all bytes so far; a
    revisit and an empty payload are one chunk without bytes, and a revisit's last two are those
    of the payload it names. A payload that does not match its digest is an error."""
    names = ["record_id", "page_id", "url", "record_type", "refers_to", "chunk_no", "data", "upto", "digest", "last"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def payload(fields: dict, stream: io.BufferedReader) -> Iterator[tuple]:
        left = int(fields["content-length"])
        told = 0
        while left:
            line = stream.readline()
            left -= len(line)
            if not line.strip():
                break
            if line.lower().startswith(b"content-length:"):
                told = int(line.split(b":")[1])
        number = lambda n: int(fields[n]) if n in fields else None
        named = fields["warc-payload-digest"].removeprefix("sha1:")
        head = (fields["warc-record-id"], number("x-page"), fields.get("warc-target-uri"), fields["warc-type"], number("x-refers-to-page"))
        if fields["warc-type"] == "revisit":
            yield (*head, 0, None, told, named, True)
            return
        sha, upto, no = hashlib.sha1(), 0, 0
        while True:
            data = _part(stream, min(chunk, left)) if left else b""
            left -= len(data)
            upto += len(data)
            sha.update(data)
            digest = base64.b32encode(sha.digest()).decode()
            if not left and digest != named:
                raise ValueError(f"payload of {head[0]} does not match its digest")
            yield (*head, no, data if with_data else None, upto, digest, not left)
            no += 1
            if not left:
                return

    def read(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches_in:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                with system.open_input_stream(path, compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16)
                    for fields in _records(stream):
                        for row in payload(fields, stream):
                            held.append(row)
                            size += 200 + len(row[6] or b"")
                            if size > 4 * CHUNK:
                                yield packed_rows(names, [list(c) for c in zip(*held, strict=True)], kinds)
                                held, size = [], 0
                if held:
                    yield packed_rows(names, [list(c) for c in zip(*held, strict=True)], kinds)

    schema = (
        "record_id string, page_id long, url string, record_type string, refers_to long, chunk_no long, data binary, "
        "upto long, digest string, last boolean"
    )
    return files.select("path").repartition(max(1, min(files.count(), 10_000))).mapInArrow(read, schema)


def archived(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row of `pages`,
    written as archives in the shared folder and read back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    folder = folder if re.match(r"[a-z0-9]+:", folder) else f"file://{folder}"
    last = chunks(written(pages, folder, least_bytes), folder, chunk, with_data=False).where("last")
    return last.select("page_id", F.col("upto").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
