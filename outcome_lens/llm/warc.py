"""Operator 8: WARC archives of pages, and a reader that splits them at any byte.

Every record is a gzip member of its own. A reading task owns the records that start in its byte range: it
looks for gzip magic, decodes a few bytes of each candidate, and takes it for a record if a WARC header comes
out; the last record is read on past the end of the range. Each writing task makes one file, which gets
its name when it is complete, so a task that is run again replaces the same file.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcome_lens.llm.common import whole_text

MAGIC = b"\x1f\x8b\x08"
LEAST_BYTES = 100  # payloads below this are written anew each time
RANGE_BYTES = 16 << 20
BUFFER = 1 << 20
MOST_HEADER = 1 << 20
DATE = "2020-01-01T00:00:00Z"
ROWS_PER_BATCH = 200
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, start long"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it."""
    if path.startswith("file:/"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed. A revisit has the headers of the response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> int:
    """Write one record per row of ``pages`` below ``folder``; the number of records written.

    The payload is the html in UTF-8, null being empty. Of equal payloads of at least ``least_bytes``, that of the
    smallest ``page_id`` is the response and the others revisit it; rows that repeat
    this ``page_id`` are responses too. Rows without an id revisit one that has an id.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), whole_text("html").alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    large = F.octet_length("html") >= least_bytes
    firsts = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1 and first is not null").drop("n")
    typed = rows.join(firsts, "digest", "left").withColumn("first", F.when(large & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    pafs.FileSystem.create_dir(*file_system(folder))

    def write(batches) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.warc.gz"
        temporary = f"{base}/.{name}.{context.taskAttemptId()}"
        out, written = None, 0
        for batch in batches:
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = system.open_output_stream(temporary)
                out.write(gzip.compress(record(page_id, url, html.encode(), digest, first, first is not None), 6, mtime=0))
                written += 1
        if out is not None:
            out.close()
            system.move(temporary, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"written": [written]})

    done = typed.select("page_id", "url", "html", "digest", "first").mapInArrow(write, "written long")
    return done.agg(F.sum("written")).first()[0] or 0


class Bytes:
    """A file's bytes by offset, read a buffer at a time."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.base, self.held = stream, size, 0, b""

    def at(self, offset: int) -> memoryview:
        """What is held from ``offset`` on; empty at the end of the file."""
        if not self.base <= offset < self.base + len(self.held):
            self.stream.seek(offset)
            self.base, self.held = offset, self.stream.read(BUFFER)
        return memoryview(self.held)[offset - self.base :]


def next_magic(data: Bytes, offset: int, end: int) -> int | None:
    """Where gzip magic starts next, before ``end``."""
    while offset < end:
        view = data.at(offset)
        if len(view) < len(MAGIC) and offset + len(view) < data.size:
            data.base, data.held = 0, b""  # magic may straddle the buffer: read again from here
            view = data.at(offset)
        found = bytes(view).find(MAGIC)
        if found >= 0:
            return offset + found if offset + found < end else None
        if offset + len(view) >= data.size:
            return None
        offset += max(1, len(view) - len(MAGIC) + 1)
    return None


def member(data: Bytes, offset: int) -> tuple[bytes, int] | None:
    """The decoded gzip member at ``offset`` and where it ends; None unless a WARC header comes out."""
    decoder, out, checked = zlib.decompressobj(31), bytearray(), False
    while True:
        view = data.at(offset)
        if not view:
            return None
        try:
            out += decoder.decompress(view if checked else view[:512])
        except zlib.error:
            return None
        offset += (len(view) if checked else min(512, len(view))) - len(decoder.unused_data)
        if not checked and len(out) >= 8:
            if not out.startswith(b"WARC/1."):
                return None
            checked = True
        if decoder.eof:
            return (bytes(out), offset) if checked else None


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def records(data: Bytes, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """The records that start in a byte range."""
    while (at := next_magic(data, start, end)) is not None:
        found = member(data, at)
        if found is None:
            start = at + 1
            continue
        raw, start = found
        yield at, *parsed(raw)


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of all ``*.warc.gz`` files below ``folder``, one row each, read in byte ranges.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for revisits. A
    response whose payload does not have its digest is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    starts = F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    number = max(1, ranges.count())

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, local = file_system(path)
                with system.open_input_file(local) as stream:
                    rows = []
                    for at, fields, block in records(Bytes(stream, size), start, min(start + range_bytes, size)):
                        rows.append(row_of(path, at, fields, block))
                        if len(rows) == ROWS_PER_BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    def row_of(path: str, at: int, fields: dict[str, str], block: bytes) -> dict:
        payload = block.partition(b"\r\n\r\n")[2]
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload digest differs in {path} at {at}")
        whole = lambda name: int(fields[name]) if name in fields else None
        row = {
            "page_id": whole("x-page-id"), "url": fields.get("warc-target-uri"), "payload_bytes": whole("x-payload-length"), "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": whole("x-refers-to-page"), "file": path, "start": at,
        }
        return row | {"payload": payload} if with_payload else row

    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RECORD.split(", "))] + [("payload", pa.binary())] * with_payload)
    spread = ranges.repartition(number, "path", "start")
    return spread.mapInArrow(read, RECORD + ", payload binary" * with_payload)
