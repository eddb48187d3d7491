"""Token ids in files of directly addressable codes.

An id is cut into chunks of bits, lowest first. Level 0 holds the first chunk of every id and a
bit that says whether the id goes on; level 1 the second chunk of those that do, and so on. The
place of an id in the next level is the number of continuation bits before it, which a rank
directory gives with one entry and at most ``RANK_BITS`` bits to count. So any id, or any run of
ids, is read from its own bytes alone; nothing is decoded block by block. Chunk widths are those
with the fewest bits for the ids of the file, found by dynamic programming over bit lengths.

1. Documents are sorted by range over their ids; a task tokenises its documents in that order
   and writes files of about ``FILE_TOKENS`` tokens. Files are named anew by each attempt and
   only the written index says which count, so a lost task leaves no trace.
2. Places in the whole corpus follow from one total per task and file.
3. Files are read back in tasks of their own; a token is found by its place in the corpus.

File: the levels (chunks, continuation bits, directory), ids of documents, their starts (one more
than documents), a JSON footer with the place of each part, its length, and the magic bytes.

Defined results
    null or empty text      the end id alone
    very long text          one document in one file, however long
    ties, repeated rows     rows with one id follow each other by a hash of their texts; each is
                            written; a null id comes first
    empty table             no files, empty result
    clashing extra columns  only the id and the text are read
"""

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import file_uri, land, partitions, text_or_empty
from starmart.llm.packing import END_ID, encoder
from starmart.storage import new_path

FILE_TOKENS = 1 << 23
RANK_BITS = 512

_MAGIC = b"TOKDAC1\n"
_WIDEST = 24  # bits of a chunk, so that it lies within four bytes wherever it begins
_READ_TOKENS = 1 << 20
_NONE = np.iinfo(np.int64).min  # a document without an id


# --- codes --------------------------------------------------------------------------


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.left_shift(np.uint64(1), np.arange(33, dtype=np.uint64)), ids.astype(np.uint64), side="right")


def best_widths(counts: np.ndarray) -> list[int]:
    """Chunk widths with the fewest bits; ``counts[k]`` ids have ``k`` bits."""
    most = max(1, int(np.max(np.flatnonzero(counts), initial=1)))
    longer = counts.sum() - np.cumsum(counts)  # ids of more than k bits
    least, step = {most: 0.0}, {}
    for done in range(most - 1, -1, -1):
        here = longer[done] if done else counts.sum()
        options = []
        for to in range(done + 1, min(done + _WIDEST, most) + 1):
            flags = 0 if to == most else 1 + 32 / RANK_BITS
            options.append((here * (to - done + flags) + least[to], to))
        least[done], step[done] = min(options)
    widths, at = [], 0
    while at < most:
        widths.append(step[at] - at)
        at = step[at]
    return widths


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each value, side by side, lowest bit first."""
    out, places = [], np.arange(width, dtype=np.uint32)
    for low in range(0, len(values), 1 << 16):  # whole bytes each time
        bits = (values[low : low + (1 << 16), None] >> places) & np.uint32(1)
        out.append(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes())
    return b"".join(out)


def unpack_bits(data: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` values that begin ``skip`` bits into the data."""
    padded = data + bytes(4)
    words = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    at = skip + np.arange(count, dtype=np.int64) * width
    return (words[at >> 3] >> (at & 7).astype(np.uint32)) & np.uint32((1 << width) - 1)


def encode(ids: np.ndarray) -> tuple[list[int], list[tuple[bytes, bytes, bytes]]]:
    """(widths, levels): chunks, continuation bits and rank directory of each level."""
    widths = best_widths(np.bincount(bit_lengths(ids), minlength=33))
    rest, levels = ids.astype(np.uint32), []
    for level, width in enumerate(widths):
        chunks = pack_bits(rest & np.uint32((1 << width) - 1), width)
        if level == len(widths) - 1:
            levels.append((chunks, b"", b""))
            break
        rest = rest >> np.uint32(width)
        goes_on = rest > 0
        flags = np.packbits(goes_on, bitorder="little").tobytes()
        per_block = np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BITS), dtype=np.int64) if len(rest) else np.zeros(0, np.int64)
        levels.append((chunks, flags, (np.cumsum(per_block) - per_block).astype("<u4").tobytes()))
        rest = rest[goes_on]
    return widths, levels


# --- files --------------------------------------------------------------------------


def write_file(path: str, docs: list[int | None], lengths: list[int], ids: np.ndarray) -> None:
    widths, levels = encode(ids)
    names = [_NONE if doc is None else doc for doc in docs]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    parts = [part for level in levels for part in level]
    parts += [np.array(names, "<i8").tobytes(), starts.astype("<i8").tobytes()]
    begins = np.cumsum([0, *map(len, parts)]).tolist()
    footer = json.dumps({"widths": widths, "begins": begins, "documents": len(docs), "tokens": len(ids)}).encode()
    system, place = fs.FileSystem.from_uri(path)
    with system.open_output_stream(place, compression=None) as file:
        for part in [*parts, footer, len(footer).to_bytes(4, "little"), _MAGIC]:
            file.write(part)


class TokenFile:
    """An open file. Reads only the bytes that hold what is asked for."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self._file = system.open_input_file(place)
        end = self._file.size()
        tail = len(_MAGIC) + 4
        closing = self._file.read_at(tail, end - tail) if end >= tail else b""
        if closing[4:] != _MAGIC:
            raise ValueError(f"{path} is not a token file")
        size = int.from_bytes(closing[:4], "little")
        footer = json.loads(self._file.read_at(size, end - tail - size))
        self.widths, self._begins = footer["widths"], footer["begins"]
        self.documents, self.tokens = footer["documents"], footer["tokens"]

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._file.close()

    def _bytes(self, part: int, first: int, last: int) -> bytes:
        """Bytes ``first`` to ``last`` of a part, as far as it goes."""
        begin, end = self._begins[part : part + 2]
        return self._file.read_at(min(begin + last, end) - begin - first, begin + first)

    def rank(self, level: int, place: int) -> int:
        """Continuation bits of a level before a place."""
        block = place // RANK_BITS
        if block * RANK_BITS == place and place:  # the directory has no entry after the last block
            block -= 1
        before = int.from_bytes(self._bytes(3 * level + 2, 4 * block, 4 * block + 4), "little")
        flags = self._flags(level, block * RANK_BITS, place)
        return before + int(flags.sum())

    def _flags(self, level: int, first: int, last: int) -> np.ndarray:
        data = np.frombuffer(self._bytes(3 * level + 1, first // 8, -(-last // 8)), np.uint8)
        return np.unpackbits(data, bitorder="little")[first % 8 :][: last - first].astype(bool)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Tokens ``first`` to ``last`` of the file."""
        if not 0 <= first <= last <= self.tokens:
            raise IndexError(f"tokens {first} to {last} of {self.tokens}")
        out, shift, owners = np.zeros(last - first, np.uint32), 0, np.arange(last - first)
        for level, width in enumerate(self.widths):
            if not len(owners):
                break
            bits = first * width
            chunk = self._bytes(3 * level, bits // 8, -(-last * width // 8))
            out[owners] |= unpack_bits(chunk, bits % 8, last - first, width) << np.uint32(shift)
            shift += width
            if level < len(self.widths) - 1:
                goes_on = self._flags(level, first, last)
                first = self.rank(level, first)
                owners = owners[goes_on]
                last = first + len(owners)
        return out

    def id_at(self, place: int) -> int:
        return int(self.ids(place, place + 1)[0])

    def directory(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the documents, where each begins, and the end)"""
        part = 3 * len(self.widths)
        docs = np.frombuffer(self._bytes(part, 0, 8 * self.documents), "<i8")
        return docs, np.frombuffer(self._bytes(part + 1, 0, 8 * self.documents + 8), "<i8")


# --- steps --------------------------------------------------------------------------

_FILES = "part int, file_no int, file string, documents bigint, tokens bigint"


def _write(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, folder: str, file_tokens: int) -> Iterator[pa.RecordBatch]:
    part, end, number = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes(), 0
    docs, texts, size = [], [], 0

    def written():
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        path = f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.tok"
        ids = np.frombuffer(b"".join(texts), "<u4")
        write_file(path, docs, [len(t) // 4 for t in texts], ids)
        return pa.RecordBatch.from_pylist([{"part": part, "file_no": number, "file": path, "documents": len(docs), "tokens": len(ids)}], _file_schema)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            docs.append(doc)
            texts.append(encoder(vocabulary).encode(text.as_py()) + end)
            size += len(texts[-1]) // 4
            if size >= file_tokens:
                yield written()
                docs, texts, size, number = [], [], 0, number + 1
    if docs:
        yield written()


_file_schema = pa.schema([("part", pa.int32()), ("file_no", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])


def write_tokens(
    docs: DataFrame,
    vocabulary: str,
    folder: str | None = None,
    id_column="doc_id",
    text="text",
    end_id=END_ID,
    file_tokens=FILE_TOKENS,
) -> DataFrame:
    """Write all documents in the order of their ids; returns the index, one row per file.

    ``base`` is the number of tokens before the file. Rows of one id are spread over several
    tasks if they are many.
    """
    folder = folder or new_path(docs.sparkSession, "tokens")
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_or_empty(text).cast("binary").alias("text"),
        F.xxhash64(text_or_empty(text)).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["doc_id", "_hash", "_row"]
    in_order = chosen.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = partial(_write, vocabulary=vocabulary, end_id=end_id, folder=file_uri(folder), file_tokens=file_tokens)
    files = land(in_order.mapInArrow(made, _FILES), "token-files")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per task
    totals = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = W.partitionBy("part").orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("tokens").over(within), F.lit(0))
    return land(files.join(offsets, "part").select("file", "documents", "tokens", (F.col("offset") + before).alias("base")), "token-index")


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with TokenFile(row["file"]) as file:
                docs, starts = file.directory()
                low = 0
                while low < len(docs):
                    high = max(low + 1, int(np.searchsorted(starts, starts[low] + _READ_TOKENS, side="right")) - 1)
                    yield _documents(file, docs, starts, low, high, row["base"], with_ids)
                    low = high


def _documents(file, docs, starts, low, high, base, with_ids) -> pa.RecordBatch:
    data = memoryview(file.ids(int(starts[low]), int(starts[high])).astype("<u4")).cast("B")
    cuts = (4 * (starts[low : high + 1] - starts[low])).tolist()
    some = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    columns = {
        "doc_id": pa.array(docs[low:high], mask=docs[low:high] == _NONE),
        "start": pa.array(starts[low:high] + base),
        "n_tokens": pa.array(np.diff(starts[low : high + 1])),
        "ids_crc32": pa.array([zlib.crc32(ids) for ids in some], pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array([bytes(ids) for ids in some], pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def read_tokens(index: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the files: ``start`` in the corpus, ``n_tokens``, crc32 and bytes of its ids."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    spread = index.select("file", "base").repartition(partitions(index.sparkSession), "file")
    return spread.mapInArrow(partial(_read, with_ids=with_ids), schema)


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, name = None, None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["file"] != name:
                if file:
                    file.__exit__()
                file, name = TokenFile(row["file"]), row["file"]
            found.append(file.id_at(row["position"] - row["base"]))
        yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(found, pa.int64())], ["position", "id"])
    if file:
        file.__exit__()


def tokens_at(index: DataFrame, positions: DataFrame, width: int = FILE_TOKENS) -> DataFrame:
    """(position, id) of the given places in the corpus, each read by itself; places outside vanish.

    Files and places meet in buckets of ``width`` tokens, a file in each that it touches.
    """
    touched = F.sequence(F.expr(f"base div {width}"), F.expr(f"(base + tokens - 1) div {width}"))
    files = index.select("file", "base", "tokens", F.explode(touched).alias("bucket"))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn("bucket", F.expr(f"position div {width}"))
    inside = (F.col("a.bucket") == F.col("f.bucket")) & (F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("tokens"))
    met = asked.alias("a").join(files.alias("f"), inside).select("file", "base", "position")
    return met.sortWithinPartitions("file", "position").mapInArrow(_look_up, "position bigint, id bigint")
