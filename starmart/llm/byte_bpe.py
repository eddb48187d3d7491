"""Byte-level BPE encoding and decoding, each distinct pre-token encoded once.

1. A task splits its texts into pre-tokens. A chunk of texts keeps each document as the
   numbers of its pre-tokens, in their order, and lists its distinct pre-tokens by hash bucket.
2. The lists meet by bucket, so all mentions of a pre-token meet in one task, which encodes it
   once. A frequent pre-token arrives once per chunk, never once per place.
3. The ids go back to their chunk, where the documents are put together by position. Chunks
   are bucketed by their number when written, so only ids move here, no text.
4. Decoding looks each id up in the table of token bytes, which is as large as the vocabulary.

Defined results
    null or empty text      no tokens
    very long text          a chunk of its own, encoded whole
    ties, repeated rows     each row is encoded
    empty table             empty result
    clashing extra columns  only the id and the text are read
"""

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial
from itertools import count
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import partitions
from starmart.storage import new_path

CHUNK_BYTES = 8 << 20

_OUT_BYTES = 8 << 20
_CHUNKS = "chunk bigint, docs array<bigint>, lengths array<int>, codes binary, buckets binary, words array<struct<bucket:int,words:binary>>"


# --- packed numbers -----------------------------------------------------------------


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte, so that empty high bytes vanish."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4")
    data = len(words).to_bytes(8, "little") + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack_words(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:8], "little")
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 8)).tolist()
    body = data[8 + 4 * n :]
    return [body[a:b] for a, b in zip([0, *ends], ends)]


# --- vocabulary ---------------------------------------------------------------------


@cache
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    # one pre-token at a time comes in, so the pattern takes all of it
    return tiktoken.Encoding("pre-token", pat_str=r"(?s:.+)", mergeable_ranks=_ranks(path), special_tokens={})


@cache
def token_bytes(path: str) -> list[bytes]:
    """The table of token bytes, by id."""
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


# --- steps --------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    find = regex.compile(pattern).findall
    number = TaskContext.get().partitionId() << 33
    kinds = pa.schema(
        [
            ("chunk", pa.int64()),
            ("docs", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int32())),
            ("codes", pa.binary()),
            ("buckets", pa.binary()),
            ("words", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))),
        ]
    )

    def fresh():
        return defaultdict(count().__next__), [], [], 0

    def row(known, docs, codes):
        words = [w.encode() for w in known]
        bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), "<u4", len(words))
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        lists = [{"bucket": int(bucket[part[0]]), "words": _pack_words([words[i] for i in part.tolist()])} for part in np.split(order, cuts) if len(part)]
        flat = np.concatenate([np.zeros(0, "<u4"), *codes])
        cells = [number, docs, [len(c) for c in codes], _pack(flat), _pack(bucket), lists]
        return pa.RecordBatch.from_arrays([pa.array([c], kind.type) for c, kind in zip(cells, kinds)], schema=kinds)

    known, docs, codes, size = fresh()
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            docs.append(doc.as_py())
            codes.append(np.array(list(map(known.__getitem__, find(text))), "<u4"))
            size += len(text)
            if size >= chunk_bytes:
                yield row(known, docs, codes)
                number += 1
                known, docs, codes, size = fresh()
    if docs:
        yield row(known, docs, codes)


def _encode_words(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Ids of the words of each list. Rows come sorted by bucket, so a word is met in one run."""
    encode = _encoding(vocabulary)._encode_single_piece
    now, known = None, {}
    for batch in batches:
        chunk, bucket, lists = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
        out = []
        for b, blob in zip(bucket, lists):
            if b != now:
                now, known = b, {}
            found = []
            for word in _unpack_words(blob.as_py()):
                if (ids := known.get(word)) is None:
                    ids = known[word] = encode(word)
                found.append(ids)
            lengths = [len(ids) for ids in found]
            flat = [i for ids in found for i in ids]
            out.append(_pack(np.array([len(found), *lengths, *flat], "<u4")))
        yield pa.RecordBatch.from_arrays([chunk, pa.array(bucket, pa.int32()), pa.array(out, pa.binary())], ["chunk", "bucket", "ids"])


def _reassemble(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    table = token_bytes(vocabulary)
    for batch in batches:
        for i in range(batch.num_rows):
            docs, lengths, codes, buckets, lists = (batch.column(c)[i].as_py() for c in ("docs", "lengths", "codes", "buckets", "ids"))
            parts = [_unpack(x["ids"]) for x in sorted(lists or [], key=lambda x: x["bucket"])]
            sizes = np.concatenate([np.zeros(0, np.int64), *(p[1 : 1 + p[0]] for p in parts)]).astype(np.int64)
            ids = np.concatenate([np.zeros(0, "<u4"), *(p[1 + p[0] :] for p in parts)])
            # lists follow the buckets; back to the order in which the chunk numbered its words
            order = np.argsort(_unpack(buckets), kind="stable")
            begin, n_ids = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            begin[order], n_ids[order] = np.cumsum(sizes) - sizes, sizes
            yield from _documents(docs, np.split(_unpack(codes), np.cumsum(lengths)[:-1]), begin, n_ids, ids, table)


def _documents(docs, codes, begin, n_ids, ids, table) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for at, (doc, words) in enumerate(zip(docs, codes)):
        n = n_ids[words]
        before = np.cumsum(n) - n
        mine = ids[np.repeat(begin[words] - before, n) + np.arange(n.sum())]
        text = b"".join(map(table.__getitem__, mine.tolist()))
        rows.append((doc, len(mine), mine.astype("<u4").tobytes(), text))
        size += 4 * len(mine) + len(text)
        if size >= _OUT_BYTES or at == len(docs) - 1:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n_tokens", "ids", "decoded"])
            rows, size = [], 0


def encode_and_decode(docs: DataFrame, vocabulary: str, pattern: str, id_column="doc_id", text="text", chunk_bytes=CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` bytes.

    ``vocabulary`` is a file that every executor has at this path, like an installed package.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = chosen.mapInArrow(partial(_chunks, pattern=pattern, buckets=n, chunk_bytes=chunk_bytes), _CHUNKS)
    # a file for each chunk and bucket at most, and a chunk is in one bucket: no shuffle needed
    name = f"bpe_chunks_{uuid4().hex}"
    made.write.bucketBy(n, "chunk").option("path", new_path(spark, "bpe-chunks")).saveAsTable(name)
    chunks = spark.table(name)
    words = chunks.select("chunk", F.explode("words").alias("w")).select("chunk", "w.bucket", "w.words")
    ids = (
        words.repartition(n, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(partial(_encode_words, vocabulary=vocabulary), "chunk bigint, bucket int, ids binary")
    )
    by_chunk = ids.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("ids"))
    joined = chunks.drop("words").join(by_chunk.hint("shuffle_hash"), "chunk", "left")
    return joined.mapInArrow(partial(_reassemble, vocabulary=vocabulary), "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
