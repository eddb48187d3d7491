"""Align the tokens of two tokenizers on the bytes of each text.

1. A task takes its documents in batches. Both sides' tokens of a batch are two tables of byte
   ranges; ``merge_asof``, keyed by document, finds for each token's start the other side's token
   that covers it. Both directions together are all overlaps. Overlapping tokens with equal ends
   close a group. A pair of ids is linked as often as their occurrences share a group; a group's
   tokens are counted by id before they are paired, so a long group of few ids is a few pairs.
2. Several batches are a chunk. A chunk keeps each document as numbers of its pairs and lists
   its different pairs, with the number of its documents that hold them, by hash bucket of the
   first id. The lists meet by bucket and give each pair's documents in the corpus and the highest
   of each first id. A frequent pair arrives once per chunk, never once per document.
3. The same lists meet these counts, and the answers go back to their chunks, where they are
   added up over each document's links. Chunks are bucketed by number when written, so only
   counts move.

The tokenizers are files that every executor has, like an installed package: a byte-level BPE in
JSON (with its public pattern of pre-tokens) and a sentencepiece model that puts a space in front.

Defined results
    null or empty text      no tokens: zeros, no groups
    other bytes than text   zeros too: a side whose tokens do not spell space and text
    very long text          a batch of its own, aligned whole
    ties, repeated rows     each row counts as a document; of equal counts all are the highest
    empty table             empty result
    clashing extra columns  only the id and the text are read
"""

import hashlib
import json
from collections.abc import Iterator
from functools import cache, partial
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import partitions
from starmart.llm.word_bpe import byte_alphabet
from starmart.storage import new_path

BATCH_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20

_MOST_DOCS = 1 << 20  # of a chunk, so that a document, and a pair of ids, fit 63 bits
_ID_BITS = 21
_PAIR_MASK = (1 << 2 * _ID_BITS) - 1
_ID_MASK = (1 << _ID_BITS) - 1
_BLOCK = 1 << 22  # pairs made at once


# --- tokenizers ---------------------------------------------------------------------


class ByteLevel:
    """Byte-level BPE of a JSON file, without special tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special, byte_of = {t["content"] for t in content.get("added_tokens") or []}, byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.table[number] = token
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self._encoding = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + text) for text in texts]


class Pieces:
    """A sentencepiece model that puts a space in front."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(self._model.get_piece_size())
        self.table = [self._raw(i, self._model.id_to_piece(i)) for i in numbers]
        self.sizes = np.array([len(t) for t in self.table], np.int64)

    def _raw(self, number: int, piece: str) -> bytes:
        if self._model.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)  # Spark owns the cores


@cache
def _byte_level(path: str, pattern: str) -> ByteLevel:
    return ByteLevel(path, pattern)


@cache
def _piece_model(path: str) -> Pieces:
    return Pieces(path)


# --- one batch ----------------------------------------------------------------------


class Side:
    """The tokens of one tokenizer for the texts of a batch, as ranges of the batch's bytes."""

    def __init__(self, ids: list[list[int]], token_sizes: np.ndarray):
        self.per_text = np.array([len(i) for i in ids], np.int64)
        self.ids = np.fromiter(chain.from_iterable(ids), np.int64, int(self.per_text.sum()))
        self.doc = np.repeat(np.arange(len(ids)), self.per_text)
        sizes = token_sizes[self.ids]
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.doc, "start": self.start, "end": self.end, "token": np.arange(len(self.ids))})


def overlaps(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """(token, other, end, other_end): each token of either side with the one that covers its start."""
    renamed = {"token": "other", "end": "other_end"}
    ahead = pd.merge_asof(left, right.rename(columns=renamed), on="start", by="doc")
    back = pd.merge_asof(right.rename(columns=renamed), left, on="start", by="doc")
    columns = ["token", "other", "end", "other_end"]
    both = pd.concat([ahead[columns], back[columns]], ignore_index=True)
    # a pair is found by both directions only where both tokens start together
    alone = ~np.isin(right["start"].to_numpy(), left["start"].to_numpy(), assume_unique=True)
    return both[np.concatenate([np.ones(len(ahead), bool), alone])]


def _by_group(group: np.ndarray, ids: np.ndarray):
    """Different ids of each group: (group, id, times), in order."""
    keys, times = np.unique((group << _ID_BITS) | ids, return_counts=True)
    return keys >> _ID_BITS, keys & _ID_MASK, times


def _pairs(doc_of_group, a_group, a_ids, b_group, b_ids) -> tuple[np.ndarray, np.ndarray]:
    """(document and pair as one number, links), each once, in order."""
    ga, ia, ta = _by_group(a_group, a_ids)
    gb, ib, tb = _by_group(b_group, b_ids)
    first = np.searchsorted(gb, np.arange(len(doc_of_group)))
    count = np.diff(np.append(first, len(gb)))[ga]  # partners of each row of the left side
    keys, links, low, before = [], [], 0, np.concatenate([[0], np.cumsum(count)])
    while low < len(ga):
        high = max(low + 1, int(np.searchsorted(before, before[low] + _BLOCK, side="right")) - 1)
        n = count[low:high]
        row = np.repeat(np.arange(low, high), n)
        other = first[ga[row]] + np.arange(before[low], before[high]) - before[row]
        key = (doc_of_group[ga[row]] << 2 * _ID_BITS) | (ia[row] << _ID_BITS) | ib[other]
        found, at = np.unique(key, return_inverse=True)
        keys.append(found)
        links.append(np.bincount(at, ta[row] * tb[other], len(found)).astype(np.int64))
        low = high
    if len(keys) < 2:
        return (keys[0], links[0]) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(links), len(found)).astype(np.int64)


@cache
def _labels(most: int) -> np.ndarray:
    """Bytes of ``,n`` ``|n`` ``;n`` for each id, padded with zeros."""
    digits = len(str(most))
    text = b"".join(f"{mark}{i}".encode().ljust(digits + 1, b"\0") for mark in ",|;" for i in range(most))
    return np.frombuffer(text, np.uint8).reshape(-1, digits + 1)


def _group_texts(n_docs: int, a: Side, a_group, b: Side, b_group, n_groups: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` of each document."""
    most = int(max(a.ids.max(initial=0), b.ids.max(initial=0))) + 1
    most = 1 << most.bit_length()  # few different tables
    n_a, n_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_before, b_before = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    labels = np.empty(len(a.ids) + len(b.ids), np.int64)
    a_at = np.arange(len(a.ids)) + b_before[a_group]
    b_at = np.arange(len(b.ids)) + a_before[b_group] + n_a[b_group]
    labels[a_at], labels[b_at] = a.ids, b.ids
    labels[b_before + a_before + n_a] += most  # the first of the second side
    labels[a_before + b_before] += 2 * most  # the first of a group
    cells = _labels(most)[labels]
    written = cells != 0
    data = cells[written].tobytes()
    size = np.cumsum(np.concatenate([[0], written.sum(axis=1)]))
    doc_of = np.empty(len(labels), np.int64)
    doc_of[a_at], doc_of[b_at] = a.doc, b.doc
    cuts = size[np.searchsorted(doc_of, np.arange(n_docs + 1))].tolist()
    return [data[x + 1 : y] if y > x else b"" for x, y in zip(cuts, cuts[1:])]  # without the first mark


class Batch:
    """Documents of a batch, aligned. ``keys`` are document and pair in one number, with their ``links``."""

    def __init__(self, texts: list[str | None], left: ByteLevel, right: Pieces):
        some = [i for i, t in enumerate(texts) if t]
        a_ids, b_ids = left.encode([texts[i] for i in some]), right.encode([texts[i] for i in some])
        kept, a_kept, b_kept = [], [], []
        for i, x, y in zip(some, a_ids, b_ids):
            raw = b" " + texts[i].encode()
            if b"".join(map(left.table.__getitem__, x)) == raw == b"".join(map(right.table.__getitem__, y)):
                kept.append(i)
                a_kept.append(x)
                b_kept.append(y)
        a, b = Side(a_kept, left.sizes), Side(b_kept, right.sizes)
        met = overlaps(a.frame(), b.frame())
        # each common end is that of one pair only, as tokens of one side do not overlap
        ends = np.sort(met.loc[met["end"] == met["other_end"], "end"].to_numpy(np.int64))
        a_group, b_group = np.searchsorted(ends, a.end), np.searchsorted(ends, b.end)
        group_doc = a.doc[np.searchsorted(a_group, np.arange(len(ends)))]
        places, n = np.array(kept, np.int64), len(texts)
        self.keys, self.links = _pairs(places[group_doc], a_group, a.ids, b_group, b.ids)
        self.counts = np.zeros((4, n), np.int64)  # both sides' tokens, groups, different pairs
        self.counts[0, places], self.counts[1, places] = a.per_text, b.per_text
        self.counts[2] = np.bincount(places[group_doc], minlength=n)
        self.counts[3] = np.bincount(self.keys >> 2 * _ID_BITS, minlength=n)
        self.groups = [b""] * n
        for i, text in zip(kept, _group_texts(len(kept), a, a_group, b, b_group, len(ends))):
            self.groups[i] = text


# --- packed numbers -----------------------------------------------------------------


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers of one length, byte by byte, so that empty high bytes vanish."""
    planes = [np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def _steps(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.diff(sorted_numbers, prepend=0)


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """By the first id only, so that all its pairs meet."""
    spread = (pairs >> _ID_BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((spread >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


# --- steps --------------------------------------------------------------------------

_LIST = pa.struct([("bucket", pa.int32()), ("pairs", pa.binary())])
_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()),
        ("docs", pa.list_(pa.int64())),
        ("counts", pa.binary()),
        ("codes", pa.binary()),
        ("buckets", pa.binary()),
        ("digests", pa.list_(pa.string())),
        ("groups", pa.list_(pa.string())),
        ("lists", pa.list_(_LIST)),
    ]
)
_CHUNK_DDL = (
    "chunk bigint, docs array<bigint>, counts binary, codes binary, buckets binary, digests array<string>, "
    "groups array<string>, lists array<struct<bucket:int,pairs:binary>>"
)


def _chunks(batches: Iterator[pa.RecordBatch], vocabularies, buckets: int, batch_bytes: int, chunk_bytes: int, with_groups: bool) -> Iterator[pa.RecordBatch]:
    left, right = _byte_level(vocabularies[0], vocabularies[2]), _piece_model(vocabularies[1])
    number = TaskContext.get().partitionId() << 33

    def row(docs, made: list[Batch], groups):
        pairs, codes = np.unique(np.concatenate([m.keys & _PAIR_MASK for m in made]), return_inverse=True)
        documents = np.bincount(codes, minlength=len(pairs))  # a document's pairs are different
        bucket = _bucket(pairs, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        lists = [
            {"bucket": int(bucket[part[0]]), "pairs": _pack(_steps(pairs[part]), documents[part])}
            for part in np.split(order, cuts)
            if len(part)
        ]
        cells = [
            number,
            docs,
            _pack(*np.concatenate([m.counts for m in made], axis=1)),
            _pack(codes, np.concatenate([m.links for m in made])),
            _pack(bucket),
            [d for d, _ in groups],
            [g for _, g in groups] if with_groups else None,
            lists,
        ]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, _CHUNK)], schema=_CHUNK)

    docs, made, groups, texts, batch_size, size = [], [], [], [], 0, 0

    def align_batch():
        made.append(Batch(texts, left, right))
        for text in made[-1].groups:
            groups.append((hashlib.sha256(text).hexdigest() if text else "", text.decode() if with_groups else None))
        made[-1].groups = None

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            docs.append(doc.as_py())
            texts.append(text)
            batch_size += len(text.encode()) if text else 0
            if batch_size >= min(batch_bytes, chunk_bytes) or len(texts) == _MOST_DOCS:
                align_batch()
                size, texts, batch_size = size + batch_size, [], 0
                if size >= chunk_bytes or len(docs) >= _MOST_DOCS:
                    yield row(docs, made, groups)
                    number, docs, made, groups, size = number + 1, [], [], [], 0
    if texts:
        align_batch()
    if docs:
        yield row(docs, made, groups)


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each pair; a partition holds the different pairs of one bucket at a time."""
    now, pairs, counts, waiting = None, [], [], 0

    def counted():
        found, documents = _summed(pairs, counts)
        first = found >> _ID_BITS
        begin = np.flatnonzero(np.diff(first, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(documents, begin), np.diff(np.append(begin, len(found))))
        blob = _pack(_steps(found), documents, documents == highest)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "pairs"])

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("pairs")):
            if bucket != now and pairs:
                yield counted()
                pairs, counts, waiting = [], [], 0
            now = bucket
            steps, documents = _unpack(blob.as_py(), 2)
            pairs.append(np.cumsum(steps))
            counts.append(documents)
            waiting += len(steps)
            if waiting > max(_BLOCK, 2 * len(pairs[0])):
                summed = _summed(pairs, counts)
                pairs, counts, waiting = [summed[0]], [summed[1]], 0
    if pairs:
        yield counted()


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each list's counts and highest marks. The bucket's own counts, without a chunk, come first."""
    known, documents, highest = (np.zeros(0, np.int64),) * 3
    for batch in batches:
        chunks, buckets, out = [], [], []
        for chunk, bucket, blob in zip(*(batch.column(c) for c in ("chunk", "bucket", "pairs"))):
            if not chunk.is_valid:
                known, documents, highest = _unpack(blob.as_py(), 3)
                known = np.cumsum(known)
                continue
            at = np.searchsorted(known, np.cumsum(_unpack(blob.as_py(), 2)[0]))
            chunks.append(chunk.as_py())
            buckets.append(bucket.as_py())
            out.append(_pack(documents[at], highest[at]))
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(buckets, pa.int32()), pa.array(out, pa.binary())], ["chunk", "bucket", "answer"])


_DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _documents(batches: Iterator[pa.RecordBatch], with_groups: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n_a, n_b, n_groups, lengths = _unpack(row["counts"], 4)
            codes, links = _unpack(row["codes"], 2)
            (bucket,) = _unpack(row["buckets"], 1)
            answers = [_unpack(x["answer"], 2) for x in sorted(row["answers"] or [], key=lambda x: x["bucket"])]
            order = np.argsort(bucket, kind="stable")  # lists follow the buckets; back to the chunk's order
            documents, highest = (np.empty(len(bucket), np.int64) for _ in range(2))
            for column, target in enumerate((documents, highest)):
                target[order] = np.concatenate([np.zeros(0, np.int64), *(a[column] for a in answers)])

            def per_document(values):
                running = np.concatenate([[0], np.cumsum(values)])
                ends = np.cumsum(lengths)
                return pa.array(running[ends] - running[ends - lengths])

            cells = {
                "doc_id": pa.array(row["docs"], pa.int64()),
                "n_a": pa.array(n_a),
                "n_b": pa.array(n_b),
                "n_groups": pa.array(n_groups),
                "n_links": per_document(links),
                "n_best": per_document(links * highest[codes]),
                "count_sum": per_document(links * documents[codes]),
                "groups_sha256": pa.array(row["digests"], pa.string()),
            }
            if with_groups:
                cells["groups"] = pa.array(row["groups"], pa.string())
            yield pa.RecordBatch.from_arrays(list(cells.values()), list(cells))


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("pairs"):
            steps, documents, highest = _unpack(blob.as_py(), 3)
            pairs = np.cumsum(steps)
            cells = [pairs >> _ID_BITS, pairs & _ID_MASK, documents, highest.astype(bool)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["a", "b", "documents", "is_best"])


class Alignment:
    """``documents``: one row per document; ``pairs``: (a, b, documents, is_best) of the corpus."""

    def __init__(self, chunks: DataFrame, with_groups: bool):
        n = partitions(chunks.sparkSession)
        lists = chunks.select("chunk", F.explode("lists").alias("l")).select("chunk", "l.bucket", "l.pairs")
        counted = lists.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_count, "bucket int, pairs binary")
        self._counted = counted
        both = counted.select(F.lit(None).cast("long").alias("chunk"), "bucket", "pairs").unionByName(lists)
        # nulls first: a bucket's counts come before the lists that ask for them
        answers = (
            both.repartition(n, "bucket")
            .sortWithinPartitions("bucket", "chunk")
            .mapInArrow(_answer, "chunk bigint, bucket int, answer binary")
            .groupBy("chunk")
            .agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
        )
        dropped = ["lists"] if with_groups else ["lists", "groups"]
        joined = chunks.drop(*dropped).join(answers.hint("shuffle_hash"), "chunk", "left")
        schema = _DOCUMENT + (", groups string" if with_groups else "")
        self.documents = joined.mapInArrow(partial(_documents, with_groups=with_groups), schema)

    @property
    def pairs(self) -> DataFrame:
        return self._counted.mapInArrow(_pair_rows, "a bigint, b bigint, documents bigint, is_best boolean")


def align(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    pattern: str,
    id_column="doc_id",
    text="text",
    batch_bytes=BATCH_BYTES,
    chunk_bytes=CHUNK_BYTES,
    with_groups=False,
) -> Alignment:
    """Align every text by both tokenizers; ``with_groups`` adds each document's groups as text."""
    spark = docs.sparkSession
    n = partitions(spark)
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = partial(_chunks, vocabularies=(byte_level, pieces, pattern), buckets=n, batch_bytes=batch_bytes, chunk_bytes=chunk_bytes, with_groups=with_groups)
    name = f"aligned_chunks_{uuid4().hex}"
    chosen.mapInArrow(made, _CHUNK_DDL).write.bucketBy(n, "chunk").option("path", new_path(spark, "aligned-chunks")).saveAsTable(name)
    return Alignment(spark.table(name), with_groups)
