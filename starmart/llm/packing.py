"""Best-fit decreasing packing of token sequences, over the whole corpus at once.

Best fit looks only at lengths, and there are at most ``capacity`` different ones. So the
driver packs the histogram of lengths, not the documents: bins with the same room left are
one group, and a segment tree over the possible rooms finds the tightest group for the next
length in logarithmic time; a step places as many pieces of that length as fit the group. The
steps, a few per length, say where the first, second, ... piece of each length goes. On the
executors each piece gets its number among those of its length (its place in its partition,
plus one offset per partition and length) and looks its step up. The result is exactly that of
best-fit decreasing over all pieces.

Defined results
    null or empty text      the end id alone
    longer than a sequence  cut into full pieces and a rest; all others stay whole
    very long text          tokenised whole
    ties, repeated rows     pieces of equal length are interchangeable; each row is packed
    empty table             empty result
    clashing extra columns  only the id and the text are read
"""

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import land
from starmart.llm.word_bpe import merges_like, plain

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 250_000  # per generation and worker


# --- tokens -------------------------------------------------------------------------


class WordIds(dict):
    """Ids of words, as bytes; a word that is missing is looked up or encoded, then kept.

    Two generations of at most ``CACHED_WORDS`` words bound the memory: words in use move on.
    """

    def __init__(self, encode, ends: bytes, older: dict):
        self.encode, self.ends, self.older = encode, ends, older

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            # a mark after a letter or digit is a token of its own, so the stem is looked up alone
            if word[-1] in self.ends and word[-2:-1].isalnum():
                return self[word[:-1]] + self[word[-1:]]
            ids = struct.pack(f"<{len(found := self.encode(word))}I", *found)
        self[word] = ids
        return ids


class WordEncoder:
    """Token ids of texts by a tokenizer that never joins tokens across ASCII space.

    Case A-Z is folded first if the tokenizer folds it anyway. Added tokens are matched before
    the tokenizer folds, so words that hold one in any case go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._ids = lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        self.folds = self._ids("Aa") == self._ids("aa")
        self.ends = bytes(m for m in b".,;:!?" if self._ids(f"a{chr(m)}") == self._ids("a") + self._ids(chr(m)))
        with open(path, encoding="utf-8") as file:
            added = {t["content"].encode() for t in json.load(file).get("added_tokens") or []}
        self.added = sorted({t.lower() if self.folds else t for t in added})
        merges = merges_like(path, self._ids)

        def encode_word(word):
            if merges and (simple := plain(word)):
                return merges.encode(simple)
            return self._ids(word.decode())

        self._encode_word = encode_word
        self.words = WordIds(encode_word, self.ends, {})

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHED_WORDS:
            self.words.older = {}
            self.words = WordIds(self._encode_word, self.ends, self.words)
        folded = text.lower() if self.folds else text
        if not any(token in folded for token in self.added):
            return b"".join(map(self.words.__getitem__, folded.split()))
        # A-Z are single bytes, so both splits give the same words
        return b"".join(map(self._word, text.split(), folded.split()))

    def _word(self, raw: bytes, folded: bytes) -> bytes:
        if any(token in folded for token in self.added):
            return struct.pack(f"<{len(found := self._ids(raw.decode()))}I", *found)
        return self.words[folded]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process; it keeps its words from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"


def _pieces(batches, path, capacity, end_id, with_ids):
    encode, part = encoder(path).encode, TaskContext.get().partitionId()
    end, seen = np.array([end_id], "<u4").tobytes(), np.zeros(capacity + 1, np.int64)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = encode(text.as_py() or b"") + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                some = ids[at : at + 4 * capacity]
                length = len(some) // 4
                row = (doc, piece, at // 4, length, zlib.crc32(some), part, int(seen[length]))
                rows.append((*row, some) if with_ids else row)
                seen[length] += 1
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def pieces(docs: DataFrame, vocabulary: str, id_column="doc_id", text="text", capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """Tokenised pieces with their number among those of the same length and partition.

    Written once, so numbers never change between the jobs that use them.
    """
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    made = partial(_pieces, path=vocabulary, capacity=capacity, end_id=end_id, with_ids=with_ids)
    return land(chosen.mapInArrow(made, _PIECES + (", ids binary" if with_ids else "")), "pieces")


# --- best fit -----------------------------------------------------------------------


class RoomTree:
    """Segment tree over rooms 0..capacity; a leaf counts the bins with that room left."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.counts = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += bins
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that some bin has."""
        node = self.leaves + least
        while not self.counts[node]:
            while node & 1:  # a right child: go up until there is a subtree to the right
                node //= 2
                if node <= 1:
                    return None
            if node == 0 or node == 1:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.counts[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_steps(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, number of the first piece, first bin, pieces per bin, offset) in order.

    From that number on, pieces of the length fill the bins one after the other.
    """
    tree, groups, steps, bins = RoomTree(capacity), {}, [], 0

    def put(room, first, count):
        if count:
            groups.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(histogram, reverse=True):
        placed, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, count = bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = groups[room].pop()
                tree.add(room, -count)
            # the bin just used is now the tightest, so it takes all it can before the next
            per_bin = room // length
            steps.append((length, placed, first, per_bin, capacity - room))
            now = min(left, count * per_bin)
            full, rest = divmod(now, per_bin)
            put(room - per_bin * length, first, full)
            put(room - rest * length, first + full, 1 if rest else 0)
            put(room, first + full + (rest > 0), count - full - (rest > 0))
            placed, left = placed + now, left - now
    return steps


def _placed(batches: Iterator[pa.RecordBatch], steps: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = (steps[:, 0] << 44) | steps[:, 1]
    order = np.argsort(keys)
    keys, steps = keys[order], steps[order]
    for batch in batches:
        length = batch.column("length").to_numpy()
        number = batch.column("number").to_numpy()
        at = np.searchsorted(keys, (length << 44) | number, side="right") - 1
        step = steps[at]
        turn = number - step[:, 1]
        sequence, before = step[:, 2] + turn // step[:, 3], turn % step[:, 3]
        kept = [n for n in batch.schema.names if n != "number"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(sequence), pa.array(step[:, 4] + before * length)],
            [*kept, "sequence_id", "offset"],
        )


def pack(docs: DataFrame, vocabulary: str, id_column="doc_id", text="text", capacity=CAPACITY, end_id=END_ID, with_ids=False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` there."""
    cut = pieces(docs, vocabulary, id_column, text, capacity, end_id, with_ids)
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = land(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "counts")
    # at most one row per possible length
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = np.array(best_fit_steps(histogram, capacity), np.int64).reshape(-1, 5)
    numbered = cut.join(counts.select("part", "length", "before"), ["part", "length"])
    kept = [c for c in cut.columns if c not in ("part", "place")]
    numbered = numbered.select(*kept, (F.col("before") + F.col("place")).alias("number"))
    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes if n in kept)
    return numbered.mapInArrow(partial(_placed, steps=steps), f"{schema}, sequence_id bigint, offset bigint")
