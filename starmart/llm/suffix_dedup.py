"""Remove later copies of long passages, by longest previous factors.

A byte goes when it lies in a string of ``length`` bytes that also starts earlier: in a
smaller document, or earlier in the same one. Over a whole corpus this takes three passes.

1. Every window of ``length`` bytes picks its least ``GRAM``-byte substring by hash; windows in
   a row with the same pick form a segment. Equal windows have equal picks. A task sends each
   different segment once, as two hashes and its first place; all further copies it already
   knows to be removable and deals in small packets to all tasks, which pass them on. Per pick,
   copies of one segment are settled by the earliest place; picks with one segment only are done.
2. The segments whose pick also occurs in other surroundings meet by pick. Their windows are
   put in suffix order; the nearest smaller places before and after a window in that order
   give its longest previous factor, and a factor of ``length`` bytes removes the window. A
   pick with more than ``hot`` segments is cut into single windows, dealt by content.
3. The removed ranges are joined to the documents and cut out.

The order of documents is their id, then the name of their file and their place in it; a null
id comes first.

Defined results
    null text               counts as empty: nothing to remove
    shorter than a window   kept whole
    very long text          read in blocks that overlap, removed over its whole length
    ties, repeated rows     rows with one id count as documents in the order of their places
    empty table             empty result
    clashing extra columns  output columns replace columns of the same name
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import ROW_ID, identified, land, partitions

LENGTH = 100
GRAM = 32
HOT = 10_000  # segments of one pick that a task compares at once

_BLOCK = 1 << 20  # bytes hashed at once; places in a block fit 20 bits
_FLUSH = 1 << 20  # segments a task holds before it sends them
_BUCKETS = 8  # groups a partition is read in, one after the other
_PACKET = 2048  # removable copies that travel together
_NONE = np.iinfo(np.int64).min  # order of a null id

_SEGMENT = np.dtype([("pick", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("start", "<i8"), ("windows", "<i4")])


# --- segments -----------------------------------------------------------------------


def _mixed(left, right, level):
    """Hash of two neighbours; not linear, so periodic texts do not collide."""
    x = left * np.uint64(0x9E3779B97F4A7C15 + 2 * level) + (right ^ (right >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all substrings of 1, 2, 4 ... 64 bytes."""
    table = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, np.uint64)
    out, size = {1: table[data]}, 1
    while size < 64 and len(out[size]) > size:
        h = out[size]
        out[2 * size] = _mixed(h[:-size], h[size:], size)
        size *= 2
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    """One to one; a least hash has small high bits, these are even again."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _span_hash(hashes, at, length):
    """Hash of ``length`` bytes at each place, from the power-of-two pieces."""
    out, offset = np.zeros(len(at), np.uint64), 0
    for size in (64, 32, 16, 8, 4, 2, 1):
        while length - offset >= size:
            out = _mixed(out, hashes[size][at + offset], size + offset)
            offset += size
    return out


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, pick's hash, content's hash) of one block.

    ``bounds`` are the ends of the texts in the block; no window crosses one.
    """
    hashes = _gram_hashes(data)
    grams = hashes[GRAM]
    places = np.arange(len(grams), dtype=np.uint64)
    keyed = (grams & ~np.uint64(_BLOCK - 1)) | places
    least = _window_least(keyed, length - GRAM + 1)
    pick = (least & np.uint64(_BLOCK - 1)).astype(np.int64)
    window = np.arange(len(pick))
    text = np.searchsorted(bounds, window, side="right")
    whole = bounds[np.minimum(text, len(bounds) - 1)] >= window + length
    new = np.ones(len(pick), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    after = np.append(np.flatnonzero(new | ~whole), len(pick))
    last = after[np.searchsorted(after, first, side="right")] - 1
    head, tail = _span_hash(hashes, first, length), _span_hash(hashes, last, length)
    content = _mixed(_mixed(head, tail, 1), (last - first).astype(np.uint64) * np.uint64(256) + (pick[first] - first).astype(np.uint64), 3)
    return first, last, _spread(grams[pick[first]]), content


def _blocks(batches: Iterator[pa.RecordBatch], length: int):
    """(data, ends, [(doc, row, place in the text)]): texts side by side, long ones in pieces."""
    parts, marks, size = [], [], 0
    for batch in batches:
        docs, texts, numbers = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            if len(text) < length:
                continue
            doc = docs[i].as_py()
            for start in range(0, len(text) - length + 1, _BLOCK // 2):
                piece = text[start : start + _BLOCK // 2 + length - 1]
                if size + len(piece) > _BLOCK and parts:
                    yield b"".join(parts), np.cumsum([len(p) for p in parts]), marks
                    parts, marks, size = [], [], 0
                parts.append(piece)
                marks.append((_NONE if doc is None else doc, numbers[i], start))
                size += len(piece)
    if parts:
        yield b"".join(parts), np.cumsum([len(p) for p in parts]), marks


def _pack(rows: np.ndarray) -> bytes:
    """Column by column and byte by byte, so that equal high bytes compress."""
    columns = [np.ascontiguousarray(rows[name]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for name in rows.dtype.names]
    return zstandard.ZstdCompressor(level=1).compress(len(rows).to_bytes(8, "little") + b"".join(columns))


def _unpack(blob: bytes, dtype: np.dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int.from_bytes(data[:8], "little"), 8
    rows = np.empty(n, dtype)
    for name in dtype.names:
        size = dtype[name].itemsize
        column = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
        rows[name] = np.ascontiguousarray(column).view(dtype[name]).ravel()
        at += n * size
    return rows


def _bucket_of(pick: np.ndarray, buckets: int) -> np.ndarray:
    """High bits, so the picks of a bucket share them and compress."""
    return ((pick >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


_SENT = pa.schema([("bucket", pa.int32()), ("removed", pa.bool_()), ("rows", pa.binary())])


def _sent(rows: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One message per bucket; the rows are sorted by pick."""
    bucket = _bucket_of(rows["pick"], buckets)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part in np.split(np.arange(len(rows)), cuts) if len(rows) else []:
        blob = _pack(rows[part])
        yield pa.RecordBatch.from_arrays([pa.array([bucket[part[0]]], pa.int32()), pa.array([False]), pa.array([blob], pa.binary())], schema=_SENT)


def _earliest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by pick, content and place; and which rows are the first of their content."""
    rows = rows[np.lexsort((rows["start"], rows["row"], rows["doc"], rows["content"], rows["pick"]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows["pick"][1:] != rows["pick"][:-1]) | (rows["content"][1:] != rows["content"][:-1])
    return rows, first


def _local_segments(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The different segments of a task, and its own later copies as removable."""
    held, count = [], 0

    def flush():
        rows, first = _earliest(np.concatenate(held))
        yield from _sent(rows[first], buckets)
        copies = rows[~first]
        copies = copies[np.lexsort((copies["start"], copies["row"]))]
        for low in range(0, len(copies), _PACKET):
            packet = copies[low : low + _PACKET]
            place = packet["row"][:1].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + packet["start"][:1].view(np.uint64)
            bucket = _bucket_of(_spread(place), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array([True]), pa.array([_pack(packet)], pa.binary())], schema=_SENT)

    for data, ends, marks in _blocks(batches, length):
        first, last, pick, content = segments(np.frombuffer(data, np.uint8), ends, length)
        text = np.searchsorted(ends, first, side="right")
        doc, row, place = (np.array(column, np.int64) for column in zip(*marks))
        begin = np.concatenate([[0], ends[:-1]])
        rows = np.empty(len(first), _SEGMENT)
        rows["pick"], rows["content"] = pick, content
        rows["doc"], rows["row"] = doc[text], row[text]
        rows["start"] = first - begin[text] + place[text]
        rows["windows"] = last - first + 1
        held.append(rows)
        count += len(rows)
        if count > _FLUSH:
            yield from flush()
            held, count = [], 0
    if held:
        yield from flush()


# --- first decision: copies of whole segments ---------------------------------------


_DECIDED = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("pick", pa.int64()), ("open", pa.bool_()), ("hot", pa.bool_())])


def _decided(rows: np.ndarray, is_open: bool, hot=None) -> pa.RecordBatch:
    hot = np.zeros(len(rows), bool) if hot is None else hot
    columns = [rows["row"], rows["doc"], rows["start"], rows["windows"], rows["pick"].view(np.int64), np.full(len(rows), is_open), hot]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_DECIDED)


def _by_bucket(batches: Iterator[pa.RecordBatch]):
    """(bucket, its rows) of a partition that is sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now and held:
                yield now, held
                held = []
            now = row["bucket"]
            held.append(row)
    if held:
        yield now, held


def _settle(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Removable copies pass through as they come; only the other segments of a bucket are held."""
    now, sent = None, []

    def settled():
        rows, first = _earliest(np.concatenate(sent))
        yield _decided(rows[~first], False)
        rows = rows[first]
        cuts = np.flatnonzero(rows["pick"][1:] != rows["pick"][:-1]) + 1
        sizes = np.diff(np.concatenate([[0], cuts, [len(rows)]]))
        contents = np.repeat(sizes, sizes)
        yield _decided(rows[contents > 1], True, contents[contents > 1] > hot)

    for batch in batches:
        for bucket, removed, blob in zip(*batch.columns):
            rows = _unpack(blob.as_py(), _SEGMENT)
            if removed.as_py():
                yield _decided(rows, False)
                continue
            if bucket.as_py() != now and sent:
                yield from settled()
                sent = []
            now = bucket.as_py()
            sent.append(rows)
    if sent:
        yield from settled()


# --- second decision: windows in suffix order ---------------------------------------


def previous_factors(windows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest previous factor of each window, up to the window's length.

    ``windows`` is a matrix of bytes and ``order`` the rank of each window's place. In suffix
    order, the longest match among earlier places is at the nearest smaller one before or
    after; both are found by following pointers, all windows at a time.
    """
    n, length = windows.shape
    by_suffix = np.lexsort((order, np.ascontiguousarray(windows).view(f"S{length}").ravel()))
    sorted_windows, place = windows[by_suffix], order[by_suffix]
    same = sorted_windows[1:] == sorted_windows[:-1]
    common = np.where(same.all(axis=1), length, same.argmin(axis=1)) if n > 1 else np.zeros(0, np.int64)

    def nearest(shared, place):
        """Match length with the nearest smaller place before each."""
        pointer, match = np.arange(-1, n - 1), np.concatenate([[0], shared])
        while True:
            # a window that matches nothing any more need not look further
            on = np.flatnonzero((pointer >= 0) & (match > 0))
            on = on[place[pointer[on]] > place[on]]
            if not len(on):
                return np.where(pointer >= 0, match, 0)
            to = pointer[on]
            match[on], pointer[on] = np.minimum(match[on], match[to]), pointer[to]

    before = nearest(common, place)
    after = nearest(common[::-1], place[::-1])[::-1]
    out = np.empty(n, np.int64)
    out[by_suffix] = np.maximum(before, after)
    return out


def _open_segments(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The bytes of segments that are still open, with a bucket; hot picks as single windows."""
    schema = pa.schema([("bucket", pa.int32()), ("pick", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        out, first = [], {}
        for r in batch.to_pylist():
            for s in r["open"]:
                size = s["windows"] + length - 1
                content = r["text"][s["start"] : s["start"] + size]
                if not s["hot"]:
                    out.append((s["pick"], s["doc"], r[ROW_ID], s["start"], content))
                    continue
                for j in range(s["windows"]):
                    window = content[j : j + length]
                    place = (s["doc"], r[ROW_ID], s["start"] + j)
                    if window in first:  # the later one is known to go: sent without its bytes
                        place, first[window] = max(place, first[window]), min(place, first[window])
                        out.append((_digest(b"%d %d" % place[1:]), *place, None))
                    else:
                        first[window] = place
        out += [(_digest(window), *place, window) for window, place in first.items()]
        if out:
            pick, doc, row, start, content = zip(*out)
            bucket = _bucket_of(np.array(pick, np.int64).view(np.uint64), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(pick, pa.int64()), pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(start, pa.int64()), pa.array(content, pa.binary())], schema=schema)


def _digest(window: bytes) -> int:
    return int.from_bytes(xxhash.xxh64_digest(window), "little", signed=True)


def _factor_ranges(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
    for _, rows in _by_bucket(batches):
        known = [r for r in rows if r["bytes"] is None]
        if known:
            starts = pa.array([r["start"] for r in known])
            ends = pa.array([r["start"] + length for r in known])
            yield pa.RecordBatch.from_arrays([pa.array([r["row"] for r in known]), starts, ends], schema=schema)
        for some in _whole_picks([r for r in rows if r["bytes"] is not None]):
            places = np.array([(r["doc"], r["row"], r["start"]) for r in some], np.int64)
            sizes = np.array([len(r["bytes"]) for r in some])
            data = np.frombuffer(b"".join(r["bytes"] for r in some), np.uint8)
            n = sizes - length + 1
            owner = np.repeat(np.arange(len(some)), n)
            shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(sizes) - sizes)[owner] + shift
            windows = np.lib.stride_tricks.sliding_window_view(data, length)[at]
            start = places[owner, 2] + shift
            order = np.empty(len(owner), np.int64)
            order[np.lexsort((start, places[owner, 1], places[owner, 0]))] = np.arange(len(owner))
            gone = np.flatnonzero(previous_factors(windows, order) >= length)
            if not len(gone):
                continue
            new = np.ones(len(gone), bool)
            new[1:] = (np.diff(gone) != 1) | (owner[gone[1:]] != owner[gone[:-1]])
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(gone)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(places[owner[gone[heads]], 1]), pa.array(start[gone[heads]]), pa.array(start[gone[tails]] + length)], schema=schema
            )


def _whole_picks(rows: list[dict], most: int = 4096) -> Iterator[list[dict]]:
    """Rows of a bucket in lots of about ``most``; rows of one pick stay together."""
    rows.sort(key=lambda r: r["pick"])
    low = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or (i - low >= most and rows[i]["pick"] != rows[i - 1]["pick"]):
            yield rows[low:i]
            low = i


# --- the operator -------------------------------------------------------------------


def repeated_ranges(docs: DataFrame, id_column="doc_id", text="text", length=LENGTH, hot=HOT) -> DataFrame:
    """(row, start, end): byte ranges that lie in strings that also start earlier.

    ``docs`` is an identified table. Ranges of one document may overlap.
    """
    n = partitions(docs.sparkSession)
    buckets = n * _BUCKETS
    plain = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"), ROW_ID)
    sent = plain.mapInArrow(partial(_local_segments, length=length, buckets=buckets), "bucket int, removed boolean, rows binary")
    met = sent.repartition(n, "bucket").sortWithinPartitions("bucket")
    decided = land(
        met.mapInArrow(partial(_settle, hot=hot), "row bigint, doc bigint, start bigint, windows int, pick bigint, open boolean, hot boolean"),
        "segments",
    )
    opened = (
        decided.filter("open")
        .groupBy(F.col("row").alias(ROW_ID))
        .agg(F.collect_list(F.struct("doc", "start", "windows", "pick", "hot")).alias("open"))
    )
    texts = docs.select(ROW_ID, F.col(text).cast("binary").alias("text"))
    surroundings = texts.join(opened.hint("shuffle_hash"), ROW_ID).select(ROW_ID, "text", "open").mapInArrow(
        partial(_open_segments, length=length, buckets=buckets), "bucket int, pick bigint, doc bigint, row bigint, start bigint, bytes binary"
    )
    factors = (
        surroundings.repartition(n, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(partial(_factor_ranges, length=length), "row bigint, start bigint, end bigint")
    )
    copies = decided.filter("not open").select("row", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end"))
    return land(factors.unionByName(copies), "ranges")


def _cut_out(batches: Iterator[pa.RecordBatch], as_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ranges = batch.column(1), batch.column(2)
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            n_bytes.append(len(text))
            if not ranges[i].is_valid:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(text)
                continue
            pairs = ranges[i].values
            steps = np.zeros(len(text) + 1, np.int64)
            np.add.at(steps, pairs.field("start").to_numpy(), 1)
            np.add.at(steps, pairs.field("end").to_numpy(), -1)
            gone = np.cumsum(steps[:-1]) > 0
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
        if as_text:  # a character of which a part is gone goes too
            kept = [k.decode(errors="ignore") for k in kept]
        cells = [*(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.string() if as_text else pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cells], ["row", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_column="doc_id", text="text", length=LENGTH, hot=HOT, as_text=False) -> DataFrame:
    """Every document with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``.

    ``row`` holds the document's other columns. ``kept`` are the remaining bytes, joined; with
    ``as_text`` they are text, without characters that a cut has split.
    """
    named = [c for c in docs.columns if c not in (text, ROW_ID)]
    docs = identified(docs)
    ranges = repeated_ranges(docs, id_column, text, length, hot)
    grouped = ranges.groupBy(F.col("row").alias(ROW_ID)).agg(F.collect_list(F.struct("start", "end")).alias("__ranges"))
    texts = docs.select(ROW_ID, F.struct(*named).alias("row"), F.col(text).cast("binary").alias("__text"))
    joined = texts.join(grouped.hint("shuffle_hash"), ROW_ID, "left").select("row", "__text", "__ranges")
    kind = "string" if as_text else "binary"
    return joined.mapInArrow(partial(_cut_out, as_text=as_text), T.StructType([joined.schema["row"], *T.StructType.fromDDL(f"n_bytes bigint, n_removed bigint, n_spans bigint, kept {kind}")]))


def cut_repeats(docs: DataFrame, id_column="doc_id", text="text", length=LENGTH) -> DataFrame:
    """The documents with their own columns, the text without repeated passages."""
    cut = remove_repeats(docs, id_column, text, length, as_text=True)
    same = {c: F.col(f"row.{c}") for c in docs.columns if c != text} | {text: F.col("kept")}
    return cut.select(*[same[c].alias(c) for c in docs.columns])
