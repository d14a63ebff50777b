"""Operator 5: WARC archives, written as one gzip member per record and read back in sequence.

The reader holds one decompressor at a time and feeds it pieces of the file: when a member
ends, the bytes after it start the next one.  A record is framed by its header block and its
Content-Length; block and payload digests (SHA-1, base32) are computed while it is read and
compared with the headers.  Writing and reading hold one record in memory.

Pages with equal payloads (size and SHA-1) are written once: the smallest page id as a
response, the others as revisits that name it.

Defined results: null html is an empty payload.  Among rows of one id with equal payloads
each is a response if the id is the smallest.  A row without an id revisits if a row with
an id has its payload; among rows without ids all are responses.  A null url has no target
header; control characters and spaces in urls are percent-encoded.  An empty table gives
no archives.  A damaged or truncated archive raises an error, a wrong digest gives
``verified`` false.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, salted_lookup
from tidemark.llm.files import new_file, open_file

PIECE = 1 << 16
ARCHIVE_BYTES = 128 << 20
BROADCAST_ROWS = 200_000
MOST_TASKS = 50_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")          # fixed value: the URL namespace of RFC 4122


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record.  A revisit holds the response's headers without the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    name = lambda i: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{i}')}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(hashlib.sha1(payload).digest())}", f"X-Payload-Length: {len(payload)}",
              f"WARC-Block-Digest: sha1:{base32_sha1(hashlib.sha1(block).digest())}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Member:
    """The decompressed bytes of one gzip member, in demand-sized pieces."""

    def __init__(self, file, pending: bytes):
        self.file, self.pending, self.z, self.held = file, pending, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail or self.pending or self.file.read(PIECE)
        if not self.z.unconsumed_tail:
            self.pending = b""
        if not data:
            raise ValueError("the archive ends within a gzip member")
        self.held += self.z.decompress(data, PIECE)
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``, however long that is (an url may have megabytes)."""
        seen = 0
        while (i := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                raise ValueError("a record's header block doesn't end")
        out, self.held = self.held[: i + len(mark)], self.held[i + len(mark):]
        return out

    def read(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> bytes:
        """Reads to the member's end; the bytes of the next member."""
        while self._more():
            pass
        if self.held:
            raise ValueError("a record is longer than its Content-Length")
        return self.z.unused_data or self.pending


def read_archive(file) -> Iterator[dict]:
    """The records of a gzipped WARC file in order: headers (lower-case names), payload (None for
    revisits), and whether the digests fit."""
    pending = file.read(PIECE)
    while pending:
        m = _Member(file, pending)
        head = m.until(b"\r\n\r\n").decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError("no WARC record at a member's start")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:] if x)}
        whole, inner, front, parts = hashlib.sha1(), hashlib.sha1(), b"", []
        http = headers.get("content-type", "").startswith("application/http")
        body = not http
        for piece in m.read(int(headers["content-length"])):
            whole.update(piece)
            if not body:
                front += piece
                at = front.find(b"\r\n\r\n")
                if at < 0:
                    continue
                body, piece = True, front[at + 4:]
            inner.update(piece)
            parts.append(piece)
        if b"".join(m.read(4)) != b"\r\n\r\n":
            raise ValueError("a record doesn't end with two line ends")
        pending = m.finish() or file.read(PIECE)
        revisit = headers.get("warc-type") == "revisit"
        fits = headers.get("warc-block-digest") in (None, f"sha1:{base32_sha1(whole.digest())}")
        if not revisit:
            fits = fits and headers.get("warc-payload-digest") in (None, f"sha1:{base32_sha1(inner.digest())}")
        yield {"headers": headers, "payload": None if revisit else b"".join(parts), "verified": fits}


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives under ``folder``.
    Returns the written manifest (path, records).  Payloads of fewer than ``revisit_from`` bytes
    are always responses."""
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
            .withColumn("same", F.concat_ws(":", F.sha1("payload"), F.octet_length("payload"))))
    first = (rows.where(F.octet_length("payload") >= revisit_from).groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 and first is not null").select("same", "first"))
    first = materialise(first, "warc-copies")
    if first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(first), "same", "left")
    else:
        joined = salted_lookup(rows, "same", first, 16, "page_id")
    todo = joined.select("page_id", "url", "payload", F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, path, size, count = None, [], "", 0, 0
        for b in batches:
            for i, u, p, r in zip(*b.columns):
                if out is None:
                    path, out = new_file(folder, ".warc.gz")
                    size = count = 0
                data = member(record(i.as_py(), u.as_py(), p.as_py(), r.as_py(), date))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((path, count))
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["path", "records"])

    return materialise(todo.mapInArrow(run, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of all archives of a manifest, an archive per task."""
    archives = max(1, min(MOST_TASKS, manifest.count()))
    fields = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, verified boolean" + (", payload binary" if payloads else "")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [f.split()[0] for f in fields.split(", ")]

    def rows(paths) -> Iterator[tuple]:
        for p in paths:
            with open_file(p.as_py()) as file:
                for r in read_archive(file):
                    h, body = r["headers"], r["payload"]
                    size = int(h["x-payload-length"]) if body is None else len(body)
                    digest = h["warc-payload-digest"].partition(":")[2] if body is None else base32_sha1(hashlib.sha1(body).digest())
                    number = lambda k: int(h[k]) if k in h else None  # noqa: E731, B023
                    yield number("x-page-id"), size, digest, h["warc-type"], number("x-refers-to-page-id"), h.get("warc-target-uri"), r["verified"], *([body] if payloads else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for r in rows(b.column(0)):
                held.append(r)
                size += 200 + (len(r[-1] or b"") if payloads else 0)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return manifest.select("path").repartition(archives).mapInArrow(run, fields)
