"""WARC records in seekable Zstandard bundles.

Records are grouped into independent frames, a bundle ends in a seek table
(a skippable frame with the sizes of all frames), and an index maps a record's
identifier to its frame and its offset in the frame's content, so that one
record is read by decompressing one frame.  Bundles are rows of a Parquet
table: every store that Spark can write to can hold them.
"""
from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import table, workspace

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
LEVEL = 3
#: Shorter payloads are stored in full, however often they occur.
REVISIT_BYTES = 100


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the headers of its payload but not the payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines.insert(-1, f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, body) of all records of a frame's content."""
    at = 0
    while at < len(content):
        headers, body, end = parse_record(content, at)
        yield at, headers, body
        at = end


def parse_record(content: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    top = content.index(b"\r\n\r\n", at)
    version, *lines = content[at:top].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {at}: {version[:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    end = top + 4 + int(headers["Content-Length"])
    if content[end:end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} does not end where its length says")
    return headers, content[top + 4:end], end + 4


class Bundle:
    """Collects records; ``close`` gives the archive and its index (record, frame, offset)."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frame_bytes, self.frames, self.sizes, self.index = frame_bytes, [], [], []
        self.open, self.open_size, self.size = [], 0, 0

    def add(self, identifier: int | None, data: bytes) -> None:
        if self.open and self.open_size + len(data) > self.frame_bytes:
            self._end_frame()
        self.index.append((identifier, len(self.frames), self.open_size))
        self.open.append(data)
        self.open_size += len(data)

    def _end_frame(self) -> None:
        content = b"".join(self.open)
        packed = self.compressor.compress(content)
        self.frames.append(packed)
        self.sizes.append((len(packed), len(content)))
        self.size += len(packed)
        self.open, self.open_size = [], 0

    def close(self) -> bytes:
        if self.open:
            self._end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(begin, compressed size, size) of every frame, from the footer alone."""
    count, flags, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    top = len(archive) - 9 - width * count
    at, out = 0, []
    for k in range(count):
        packed, size = struct.unpack_from("<II", archive, top + width * k)
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(archive: bytes, entry: tuple[int, int, int]) -> bytes:
    begin, packed, size = entry
    return zstandard.ZstdDecompressor().decompress(archive[begin:begin + packed], max_output_size=size)


def read_record(archive: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index."""
    headers, body, _ = parse_record(read_frame(archive, seek_table(archive)[frame]), offset)
    return headers, body


_BUNDLES = ("bundle string, archive binary, "
            "records array<struct<page_id: bigint, frame: int, offset: bigint>>")
_BUNDLES_ARROW = pa.schema([("bundle", pa.string()), ("archive", pa.binary()), ("records", pa.list_(
    pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64())])))])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(bundle):
        archive = bundle.close()
        index = [{"page_id": i, "frame": f, "offset": o} for i, f, o in bundle.index]
        name = hashlib.sha256(archive).hexdigest()[:32]
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([archive], pa.binary()), pa.array([index], _BUNDLES_ARROW.field("records").type)],
            schema=_BUNDLES_ARROW)

    bundle = Bundle()
    for batch in batches:
        for page_id, url, html, refers_to in zip(*[batch.column(n) for n in ("page_id", "url", "html", "refers_to")]):
            payload = (html.as_py() or "").encode()
            bundle.add(page_id.as_py(), record(
                page_id.as_py(), url.as_py(), payload, hashlib.sha256(payload).hexdigest(), refers_to.as_py()))
            if bundle.size + bundle.open_size >= BUNDLE_BYTES:
                yield closed(bundle)
                bundle = Bundle()
    if bundle.index:
        yield closed(bundle)


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, frame int, offset bigint"
_READ_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                         ("record_type", pa.string()), ("refers_to", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64())])


def _identifier(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column("archive"):
            archive = archive.as_py()
            rows = []
            for frame, entry in enumerate(seek_table(archive)):
                for offset, headers, body in parse_records(read_frame(archive, entry)):
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    length = int(headers["X-Payload-Length"])
                    if kind == "response" and (len(body) != length or hashlib.sha256(body).hexdigest() != digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
                    rows.append((_identifier(headers["WARC-Record-ID"]), length, digest, kind,
                                 _identifier(headers.get("WARC-Refers-To")), frame, offset))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ_ARROW)], schema=_READ_ARROW)


def write_bundles(pages: DataFrame) -> DataFrame:
    """bundle, archive, records of all pages, as a written table.

    Of pages with equal payloads of at least REVISIT_BYTES bytes, the one with
    the smallest page_id is stored in full and the others refer to it.
    """
    work = workspace(pages)
    html = F.coalesce("html", F.lit(""))
    marks = work.stage(pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("bytes")), "digests")
    first = work.stage(
        marks.where(f"bytes >= {REVISIT_BYTES}").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1"), "repeated")
    revisits = work.stage(
        marks.join(first, "digest").where("page_id > first").select(
            F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("first").alias("refers_to")).distinct(), "revisits")
    rows = pages.select("page_id", "url", "html", F.sha2(html, 256).alias("digest")).join(
        revisits, (F.col("page_id") == F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return work.stage(rows.select("page_id", "url", "html", "refers_to").mapInArrow(_write, _BUNDLES), f"bundles-{uuid.uuid4().hex[:8]}")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, its payload held against its digest."""
    return bundles.select("archive").mapInArrow(_read, _READ)


def archive_pages(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read back from the written bundles.

    One row per input row.  Null html is an empty payload.  Rows that repeat a
    page_id are records of their own; those with the payload's smallest page_id
    are all stored in full, as is a page without an id.  An empty table gives
    no rows.  Only page_id, url and html are read.
    """
    return read_bundles(write_bundles(pages)).drop("frame", "offset")


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))
