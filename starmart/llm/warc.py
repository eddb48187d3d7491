"""WARC records in seekable Zstandard bundles.

Each task writes its records to one file of independent Zstandard frames. A frame holds whole
records up to ``frame_bytes``; a skippable frame at the end is the seek table of the published
seekable format, so any tool that knows it can jump to a frame. The index maps a record to its
archive, its frame and its offset within the unpacked frame.

Of pages with equal payloads of at least ``least_bytes``, the one with the largest id is stored
and the others are revisits of it.

Archives are written through ``pyarrow.fs`` to the shared folder, under a name that is new for
each attempt; the index, written by Spark, names those of attempts that succeeded. What a lost
attempt left behind is never read.

Defined results
    null html               counts as empty
    null url, control characters in it   a name made of the page id; percent-encoded
    null page id            written without one; never the largest of a group
    very long text          a frame of its own
    ties, repeated rows     all rows with the id that is stored are responses
    empty table             no archives, empty result
    clashing extra columns  only the id, url and html are read
"""

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import land
from starmart.storage import new_path

LEAST_BYTES = 1000
FRAME_BYTES = 1 << 20
WRITTEN_AT = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format: skippable frame, end of the seek table.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1

_INDEX = "record_id string, page_id bigint, archive string, frame_offset bigint, frame_size bigint, offset bigint, size bigint"
_READ = "record_id string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


# --- which pages are stored ---------------------------------------------------------


def with_targets(pages: DataFrame, page_id="page_id", url="url", html="html", least_bytes=LEAST_BYTES) -> DataFrame:
    """Pages with their payload, and the page that a revisit refers to."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = (
        rows.filter(F.length("payload") >= least_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("key", "target")
    )
    # both sides come straight from an exchange, so a payload of a third of all pages is split
    joined = rows.join(land(groups, "payloads"), "key", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


# --- records ------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'page {page_id}'.encode()).hexdigest())}>"


def _safe(url: str | None, page_id) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def build_record(page_id, url, payload: bytes, refers_to) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", WRITTEN_AT),
        ("WARC-Target-URI", _safe(url, page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", record_id(refers_to)))
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
        block = head
    else:
        block = head + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(fields, block, where the next record begins)"""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    begin, size = end + 4, int(fields["Content-Length"])
    return fields, data[begin : begin + size], begin + size + 4


# --- bundles ------------------------------------------------------------------------


class BundleWriter:
    """One archive file. Its memory is one frame."""

    def __init__(self, folder: str, frame_bytes: int):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        self.file = system.open_output_stream(fs.FileSystem.from_uri(self.name)[1], compression=None)
        self.packer, self.frame_bytes = zstandard.ZstdCompressor(level=3), frame_bytes
        self.records, self.size, self.written, self.frames = [], 0, 0, []

    def add(self, page_id, record: bytes) -> Iterator[tuple]:
        if self.records and self.size + len(record) > self.frame_bytes:
            yield from self.flush()
        self.records.append((page_id, record, self.size))
        self.size += len(record)

    def flush(self) -> Iterator[tuple]:
        if not self.records:
            return
        packed = self.packer.compress(b"".join(r for _, r, _ in self.records))
        self.file.write(packed)
        for page_id, record, offset in self.records:
            yield record_id(page_id), page_id, self.name, self.written, len(packed), offset, len(record)
        self.frames.append((len(packed), self.size))
        self.written += len(packed)
        self.records, self.size = [], 0

    def close(self) -> Iterator[tuple]:
        yield from self.flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.file.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(archive: str) -> list[tuple[int, int]]:
    """(offset, packed size) of each frame, from the end of an archive."""
    system, path = fs.FileSystem.from_uri(archive)
    with system.open_input_file(path) as file:
        file.seek(file.size() - 9)
        count, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != _SEEKABLE:
            raise ValueError(f"{archive} has no seek table")
        file.seek(file.size() - 9 - 8 * count)
        sizes = [packed for packed, _ in struct.iter_unpack("<II", file.read(8 * count))]
    return list(zip(accumulate(sizes, initial=0), sizes))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_INDEX_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("frame_offset", pa.int64()), ("frame_size", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())])
_READ_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int) -> Iterator[pa.RecordBatch]:
    writer = None
    for batch in batches:
        rows = []
        writer = writer or (BundleWriter(folder, frame_bytes) if batch.num_rows else None)
        for page_id, url, payload, refers_to in zip(*batch.columns):
            page_id, refers_to = page_id.as_py(), refers_to.as_py()
            rows += writer.add(page_id, build_record(page_id, url.as_py(), payload.as_py(), refers_to))
        if rows:
            yield _rows(rows, _INDEX_SCHEMA)
    if writer:
        if rows := list(writer.close()):
            yield _rows(rows, _INDEX_SCHEMA)


def _unpacked(archive: str, offset: int, size: int) -> bytes:
    system, path = fs.FileSystem.from_uri(archive)
    with system.open_input_file(path) as file:
        return zstandard.ZstdDecompressor().decompress(file.read_at(size, offset))


def _as_row(fields: dict[str, str], block: bytes) -> tuple:
    payload = None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    size = number("X-Payload-Length") if payload is None else len(payload)
    return fields["WARC-Record-ID"], number("X-Page-ID"), fields["WARC-Type"], number("X-Refers-To-Page-ID"), size, digest, payload


def _read_frames(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for frame in batch.to_pylist():
            data, at, rows = _unpacked(frame["archive"], frame["frame_offset"], frame["frame_size"]), 0, []
            while at < len(data):
                fields, block, at = parse_record(data, at)
                row = _as_row(fields, block)
                rows.append(row if with_payload else (*row[:-1], None))
            yield _rows(rows, _READ_SCHEMA)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            data = _unpacked(r["archive"], r["frame_offset"], r["frame_size"])
            rows.append(_as_row(*parse_record(data, r["offset"])[:2]))
        if rows:
            yield _rows(rows, _READ_SCHEMA)


def write_archives(pages: DataFrame, folder: str | None = None, frame_bytes=FRAME_BYTES, **columns) -> DataFrame:
    """Write all pages to archives below ``folder``; returns the index, one row per record."""
    folder = folder or new_path(pages.sparkSession, "warc")
    records = with_targets(pages, **columns)
    return land(records.mapInArrow(partial(_write, folder=_uri(folder), frame_bytes=frame_bytes), _INDEX), "warc-index")


def _uri(folder: str) -> str:
    """file:/a, as Hadoop writes it, in the form with an authority."""
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, frame by frame; payloads are checked by their digests."""
    frames = index.select("archive", "frame_offset", "frame_size").distinct()
    return frames.mapInArrow(partial(_read_frames, with_payload=with_payload), _READ)


def fetch(index: DataFrame) -> DataFrame:
    """Only the records of the given index rows, each through its frame and offset."""
    return index.mapInArrow(_fetch, _READ)
