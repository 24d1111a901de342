"""WARC archives: a writer with one gzip member per record and a sequential reader that checks every digest.

An archive is a row with its bytes, bounded by ``ARCHIVE_BYTES`` of payload (a larger single record has one of its own).
Archives in a store are read with ``spark.read.format("binaryFile")``, whose ``path`` and ``content`` fit the reader.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lookup, written

#: Payload bytes after which a writer begins a new archive.
ARCHIVE_BYTES = 8 << 20
#: Decompressed bytes that the reader asks for at a time.
CHUNK = 1 << 16
#: Fixed values of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
#: First bytes of a gzip member (fixed: magic number and the deflate method).
GZIP_HEAD = b"\x1f\x8b\x08"

ARCHIVE_SCHEMA = "path string, content binary"
RECORD_SCHEMA = (
    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, "
    "payload_digest string, payload binary, error string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head of the full payload, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
    ]
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def _one_line(value: str) -> str:
    """A header value can't hold line breaks; they are written as in a URI."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def _write(date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, first = [], 0, None
        for batch in batches:
            for kind, record_id, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = first or record_id
                parts.append(record_bytes(kind, record_id, uri, payload, refers_to, date))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield _archive(first, parts)
                    parts, size, first = [], 0, None
        if parts:
            yield _archive(first, parts)

    return write


def _archive(first: str, parts: list[bytes]) -> pa.RecordBatch:
    name = hashlib.sha1(first.encode()).hexdigest()
    return pa.RecordBatch.from_pydict({"path": [f"{name}.warc.gz"], "content": pa.array([b"".join(parts)], pa.binary())})


def write_archives(records: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """``path, content`` of archives with a record for each row ``kind, record_id, uri, payload, refers_to``.

    ``kind`` is ``response`` or ``revisit`` (of the record named in ``refers_to``). Ids must not be NULL, a NULL payload is
    empty, a NULL uri is ``about:blank``. An empty table gives no archives. Other columns are not looked at.
    """
    rows = records.select(
        "kind", "record_id", F.coalesce("uri", F.lit("about:blank")).alias("uri"),
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"), "refers_to",
    )
    return rows.mapInArrow(_write(date), ARCHIVE_SCHEMA)


class _Member:
    """Reads one gzip member, a chunk at a time."""

    def __init__(self, data: memoryview, start: int):
        self.data, self.at, self.engine, self.buffer = data, start, zlib.decompressobj(31), bytearray()
        self.tail = b""

    def more(self) -> bool:
        """Decompress another chunk; False at the member's end. Raises zlib.error, or EOFError where the archive is cut off."""
        if self.engine.eof:
            return False
        if not self.tail:
            self.tail = bytes(self.data[self.at : self.at + CHUNK])
            self.at += len(self.tail)
            if not self.tail:
                raise EOFError("archive ends within a record")
        self.buffer += self.engine.decompress(self.tail, CHUNK)
        self.tail = self.engine.unconsumed_tail
        if self.engine.eof:
            self.at -= len(self.engine.unused_data)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise ValueError("record is shorter than its content length")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (i := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.more():
                raise ValueError("header has no end")
        return self.take(i + len(mark))

    def rest(self) -> bytes:
        while self.more():
            pass
        out, self.buffer = bytes(self.buffer), bytearray()
        return out


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8", "replace").rstrip("\r\n").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _unwrap(value: str | None) -> str | None:
    return value.strip("<>") if value is not None else None


def _parse(member: _Member) -> dict:
    """The record's fields; ``error`` says what is wrong with a record that can still be framed."""
    version, head = _headers(member.until(b"\r\n\r\n"))
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    block = member.take(int(head["content-length"]))
    error = None if member.rest() == b"\r\n\r\n" else "record does not end after its content length"
    payload, size = block, len(block)
    if head.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_headers(http)[1].get("content-length", len(payload)))
    revisit, digest = head.get("warc-type") == "revisit", head.get("warc-payload-digest", "").removeprefix("sha1:")
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        error = "block digest differs"
    elif not revisit and digest and digest != sha1_base32(payload):
        error = "payload digest differs"
    elif not revisit and size != len(payload):
        error = "payload length differs"
    return {
        "record_type": head.get("warc-type"), "record_id": _unwrap(head.get("warc-record-id")), "target_uri": head.get("warc-target-uri"),
        "refers_to": _unwrap(head.get("warc-refers-to")), "payload_bytes": size, "payload_digest": digest or sha1_base32(payload),
        "payload": None if revisit else payload, "error": error,
    }


def records_of(path: str, content: bytes) -> Iterator[dict]:
    """The records of one archive in order. A range that can't be framed gives a row with its offset and what is wrong."""
    data, at = memoryview(content), 0
    while at < len(data):
        member = _Member(data, at)
        try:
            yield {"path": path, "offset": at, **_parse(member)}
            at = member.at
        except (zlib.error, EOFError, ValueError, KeyError) as error:
            on = _next_record(content, at + 1)
            yield {"path": path, "offset": at, "error": f"{str(error) or type(error).__name__}; skipped {on - at} bytes"}
            at = on


def _next_record(content: bytes, at: int) -> int:
    """The next place of a gzip head whose content begins as a record does, or the archive's end."""
    while (at := content.find(GZIP_HEAD, at)) >= 0:
        try:
            if zlib.decompressobj(31).decompress(content[at : at + CHUNK], 5) == b"WARC/":
                return at
        except zlib.error:
            pass
        at += 1
    return len(content)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, size = [], 0
            for row in records_of(path.as_py(), content.as_py() or b""):
                rows.append(row)
                size += len(row.get("payload") or b"") + 500
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives ``path, content``, in the columns of ``RECORD_SCHEMA``.

    Every member is decompressed in chunks, framed by its content length and checked against its digests; ``error`` is NULL
    for a good record. A record whose digest or length differs is returned with its error; a range that is cut off, damaged or
    no WARC gives a row that has only path, offset and error, and reading goes on at the next record behind it. A NULL or empty content gives no rows. ``payload_bytes`` and
    ``payload_digest`` of a revisit are those of the payload it refers to; its ``payload`` is NULL.
    """
    return archives.select("path", "content").mapInArrow(_read, RECORD_SCHEMA)


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """Rows ``id, digest, size, keeper``: keeper is the largest id with an equal payload of at least ``min_bytes``, or NULL.

    A NULL id is never a keeper, unless no row of its payload has an id; then keeper is NULL.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    sketch = written(pages.select(F.col(id_col).alias("id"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size")))
    groups = sketch.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.max("id").alias("keeper"))
    return lookup(sketch, written(groups.where("_n > 1")), ["digest"], "_n", "left")


def page_records(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
    id_prefix: str = "urn:page:",
) -> DataFrame:
    """The records to write for pages: equal payloads of at least ``min_bytes`` are stored once, by the largest id.

    A page whose id is NULL or repeats another's with the same payload is a response of its own with a made-up id.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    facts = with_revisits(pages, id_col, payload_col, min_bytes).groupBy("id", "digest").agg(F.max("keeper").alias("keeper"))
    rows = pages.select(F.col(id_col).alias("own_id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("own_digest", F.sha1("payload"))
    rows = rows.join(facts, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("digest")), "left")
    revisit = F.col("own_id").isNotNull() & F.col("keeper").isNotNull() & (F.col("own_id") != F.col("keeper"))
    name = F.coalesce(F.concat(F.lit(id_prefix), F.col("own_id").cast("string")), F.concat(F.lit("urn:sha1:"), F.col("own_digest")))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"), name.alias("record_id"), "uri", "payload",
        F.when(revisit, F.concat(F.lit(id_prefix), F.col("keeper").cast("string"))).alias("refers_to"),
    )
