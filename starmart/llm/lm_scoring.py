"""Log-bilinear language model, trained by noise-contrastive estimation.

The score of word w after word h is r(h) . q(w) + b(w). Symbols are the most frequent words, one
class for all other words, and the end of a text; there are ``SYMBOLS_PER_ROOT`` times the root of
the number of training tokens, so they grow with the corpus and normalisers cost as much per token
at any size; a word of that class is then drawn by
add-one smoothed counts. Training contrasts the pairs of the corpus with words drawn from the
unigram distribution. Because a context is one symbol, one matrix product per block of contexts
gives every normaliser, and each token's probability is exact.

1. Words are counted over all training texts, first within a task.
2. Texts become symbol numbers. Frequent words (at most ``TOP_WORDS``, or as many as there are
   symbols, of at most ``TOP_WORD_BYTES`` bytes) are looked up in a broadcast table; all other
   words are joined with their counts by a shuffle.
3. Each task trains on the counted pairs of its texts, starting from the common parameters and
   step sizes; these are averaged over tasks, weighted by how often each task met a symbol. A
   round uses all of them. Tasks, and texts of a task, grow with the square root of the corpus, so
   a larger corpus gives each copy more steps. Training texts of another remainder (``JUDGES``)
   are counted but not trained on: after each round they are scored; training ends when they get
   worse or after ``ROUNDS``, and the best model of these, the unigram start included, is kept.
   Held-out texts are scored once, by that model, and decide nothing.
4. Token scores are summed per document.

Defined results
    null or empty text      the end token alone
    null id                 not held out
    nothing to learn from   all words unknown
    very long text          scored whole
    ties, repeated rows     scored one by one, alike; a word's tie in count goes by its bytes
    empty table             empty result
    clashing extra columns  only the id and the text are read
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ROW_ID, is_held_out, land

TOP_WORDS = 1 << 17
TOP_WORD_BYTES = 64
SYMBOLS_PER_ROOT = 8
LEAST_SYMBOLS = 1 << 14  # with the class of other words and the end
DIMENSIONS = 8
NOISE = 64
ROUNDS = 3  # passes over all training texts, at most
JUDGES = 3  # remainder of the training texts that decide when to stop
LEARNING_RATE = 0.1

_END_WORD = b""  # stands for the end in the table of counts; no word is empty
_SPLIT_BYTES = 1 << 23  # of texts that are split into words at once
_COUNTED_WORDS = 400_000  # distinct words a task counts before it passes them on
_PAIRED_TOKENS = 4_000_000
_COPY_TOKENS = 250_000  # a corpus of n times as many tokens trains sqrt(n) copies
_BATCH = 8192
_LEAST_BATCH = 128  # few pairs are split into up to 64 steps of as many at least
_SCORED_TOKENS = 1 << 14  # so that their rows of parameters stay in the cache
_SCORED_AT_ONCE = 200_000
_BLOCK = 1024  # symbols per row when parameters are averaged
_SUMMED = 1 << 14  # targets whose scores are held at once for a normaliser
_STOP_CONTEXTS = 1 << 14  # most frequent contexts after which tokens decide when to stop


def _pieces(batch: pa.RecordBatch, texts: int) -> Iterator[pa.RecordBatch]:
    """Of about as many bytes of text, so that the words of a batch are not all held at once."""
    size = np.cumsum(pc.binary_length(batch.column(texts)).fill_null(0).to_numpy(), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(size // _SPLIT_BYTES)) + 1).tolist(), batch.num_rows]
    return (batch.slice(low, high - low) for low, high in zip(cuts, cuts[1:]) if high > low)


def _split(texts: pa.Array) -> pa.ListArray:
    """The words of each text, and empty ones where space begins or ends it."""
    kind = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    return pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null(b"").view(kind)))  # A-Z only, ASCII space only


# --- counts -------------------------------------------------------------------------


_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def added_up():
        return pa.Table.from_batches(held, _COUNTS).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(_COUNTS.names)

    for batch in batches:
        for piece in _pieces(batch, 0):
            words, n = _split(piece.column(0)).flatten().value_counts().flatten()
            held.append(pa.RecordBatch.from_arrays([words.cast(pa.binary()), n], schema=_COUNTS).filter(pc.greater(pc.binary_length(words), 0)))
            size += held[-1].num_rows
            if size > 2 * _COUNTED_WORDS:
                table = added_up()
                if table.num_rows > _COUNTED_WORDS:
                    yield from table.to_batches()
                    table = table.slice(0, 0)
                held, size = table.to_batches(), table.num_rows
        held.append(pa.RecordBatch.from_arrays([pa.array([_END_WORD]), pa.array([batch.num_rows])], schema=_COUNTS))
    yield from added_up().to_batches()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of every distinct word, and of the end under the empty word."""
    partial_counts = texts.mapInArrow(_count, "word binary, n bigint")
    return land(partial_counts.groupBy("word").agg(F.sum("n").alias("n")), "words")


@dataclass
class Vocabulary:
    """The frequent words, most frequent first, and the totals of the corpus."""

    words: list[bytes]
    counts: np.ndarray
    least: int  # every shorter word with this count or more is among the words
    tokens: int
    distinct: int
    ends: int
    symbols: int

    @property
    def named(self) -> int:
        return min(len(self.words), self.symbols - 2)

    @property
    def other(self) -> int:
        return self.named

    @property
    def end(self) -> int:
        return self.named + 1

    def symbol_counts(self) -> np.ndarray:
        top = self.counts[: self.named]
        return np.concatenate([top, [self.tokens - self.ends - top.sum(), self.ends]]).astype(np.float64)

    def other_slots(self) -> float:
        """Tokens and distinct words of the class of other words, and one unseen word."""
        return float(self.symbol_counts()[self.other] + self.distinct - self.named - (self.ends > 0) + 1)


def frequent(counts: DataFrame, top_words: int = TOP_WORDS, symbols: int | None = None) -> Vocabulary:
    """The words above a count that at most ``top_words`` words reach.

    The count is found in a histogram with exact low and logarithmic high classes, so neither
    a sort of all words nor more than ``top_words`` rows reach the driver. Without ``symbols``
    their number follows the tokens, and ``top_words`` is at least as large.
    """
    word = F.col("word") != F.lit(_END_WORD)
    total = counts.agg(F.sum("n").alias("tokens"), F.count_if(F.col("n") > 0).alias("words"), F.sum(F.when(~word, F.col("n"))).alias("ends")).first()
    if symbols is None:
        symbols = max(LEAST_SYMBOLS, int(SYMBOLS_PER_ROOT * np.sqrt(total.tokens or 0)))
        top_words = max(top_words, symbols)
    short = counts.filter(word & (F.length("word") <= TOP_WORD_BYTES))
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise((F.floor(F.log2("n") * 32) + 1024).cast("long"))
    levels = short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    least, room = 1 << 62, top_words
    for step in sorted(levels, key=lambda x: -x.least):
        room -= step.words
        if room < 0:
            break
        least = step.least
    table = short.filter(F.col("n") >= least).select("word", "n").toArrow()
    rows = sorted(zip(table["word"].to_pylist(), table["n"].to_pylist()), key=lambda r: (-r[1], r[0]))
    return Vocabulary([w for w, _ in rows], np.array([n for _, n in rows], np.int64), least, total.tokens or 0, total.words or 0, total.ends or 0, symbols)


# --- symbol numbers -----------------------------------------------------------------


_CODED = "doc_id bigint, held_out boolean, judges boolean, n_tokens bigint, n_known bigint, base_sum double, other_sum double, n_other bigint, ids binary, rare array<binary>"


def _to_bytes(ids: np.ndarray) -> bytes:
    """Low halves, then high halves: the latter are nearly all alike and compress."""
    return (ids & 0xFFFF).astype("<u2").tobytes() + (ids >> 16).astype("<u2").tobytes()


def _from_bytes(blob: bytes) -> np.ndarray:
    halves = np.frombuffer(blob, "<u2").astype(np.uint32).reshape(2, -1)
    return halves[0] | halves[1] << 16


def _code(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    missing, end = len(vocabulary.words), len(vocabulary.words) + 1  # places behind the frequent words
    logs = np.log10(np.concatenate([vocabulary.counts, [0, vocabulary.ends]]) + 1.0)
    symbols = np.full(end + 1, vocabulary.other, np.uint32)
    symbols[: vocabulary.named], symbols[end] = np.arange(vocabulary.named), vocabulary.end
    frequent_words = pa.array(vocabulary.words, pa.binary()).view(pa.string())
    for batch in batches:
        for piece in _pieces(batch, 3):
            texts = _split(piece.column(3))
            words, bounds = texts.flatten(), texts.offsets.to_numpy()
            full = pc.greater(pc.binary_length(words), 0)
            words, bounds = words.filter(full), np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[bounds]
            places = pc.index_in(words, frequent_words.cast(words.type)).fill_null(missing).to_numpy()
            rare = places == missing
            at = np.insert(places, bounds[1:], end)
            heads, ends = bounds[:-1] + np.arange(len(texts)), bounds[1:] + np.arange(len(texts))
            gain, unnamed, ids = logs[at], symbols[at] == vocabulary.other, symbols[at]
            n_rare = np.diff(np.append(0, np.cumsum(rare))[bounds])
            columns = [
                ends - heads + 1,
                ends - heads - n_rare + (vocabulary.ends > 0),
                np.add.reduceat(gain, heads),
                np.add.reduceat(np.where(unnamed, gain, 0.0), heads),
                np.add.reduceat(unnamed, heads, dtype=np.int64),
                pa.array([_to_bytes(ids[low : high + 1]) for low, high in zip(heads, ends)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rare)), pa.int32()), words.filter(pa.array(rare)).cast(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in range(3)), *map(pa.array, columns)], ["doc_id", "held_out", "judges", "n_tokens", "n_known", "base_sum", "other_sum", "n_other", "ids", "rare"])


# --- training -----------------------------------------------------------------------


@dataclass
class Model:
    contexts: np.ndarray  # r, a row per symbol
    targets: np.ndarray  # q
    biases: np.ndarray  # b
    seen: np.ndarray | None = None  # squared gradients so far, of r, q and b


def start(counts: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """The unigram model: targets are zero, so contexts do not matter yet."""
    share = (counts + 1) / (counts + 1).sum()
    rng = np.random.Generator(np.random.PCG64(1))
    contexts = rng.normal(0, 0.3, (len(counts), dimensions)).astype(np.float32)
    return Model(contexts, np.zeros((len(counts), dimensions), np.float32), np.log(share).astype(np.float32))


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the rows by number, then place; where each number starts; the numbers.

    A place shares a key with its number, as plain keys are sorted faster than a stable order.
    """
    bits = len(rows).bit_length()
    keys = np.sort(rows << bits | np.arange(len(rows)))
    order, rows = keys & ((1 << bits) - 1), keys >> bits
    heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    return order, heads, rows[heads]


class Contrast:
    """Noise-contrastive training of one copy of the parameters, with AdaGrad by row."""

    def __init__(self, model: Model, counts: np.ndarray, noise: int = NOISE, rate: float = LEARNING_RATE, seed=0):
        self.r, self.q, self.b = model.contexts.copy(), model.targets.copy(), model.biases.copy()
        share = (counts + 1) / (counts + 1).sum()
        self.noise, self.rate, self.rng = noise, rate, np.random.Generator(np.random.PCG64(seed))
        self.log_noise = np.log(noise * share).astype(np.float32)
        self.cumulative = np.cumsum(share)
        n = len(counts)
        self.seen = np.ones((3, n), np.float32) if model.seen is None else model.seen.copy()
        self.met_context, self.met_target = np.zeros(n), np.zeros(n)

    def _descend(self, table, seen, runs, gradient) -> None:
        """Add up the gradients of equal rows, then step."""
        order, heads, at = runs
        total = np.add.reduceat(gradient.take(order, axis=0), heads, axis=0)
        so_far = seen.take(at)
        so_far += (total * total).mean(axis=1) if total.ndim > 1 else total * total
        seen[at] = so_far
        step = self.rate / np.sqrt(so_far)
        total *= step[:, None] if total.ndim > 1 else step
        table[at] = table.take(at, axis=0) + total

    def learn(self, context, target, weight) -> None:
        """One step on a batch of pairs; the batch shares its noise words."""
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.noise)), len(self.b) - 1)
        r, q, n = self.r.take(context, axis=0), self.q.take(target, axis=0), self.q[drawn]
        true = np.einsum("ij,ij->i", r, q) + self.b.take(target) - self.log_noise.take(target)
        up = weight / (1 + np.exp(true))
        down = r @ -n.T  # in place: this is the largest array
        down -= self.b[drawn] - self.log_noise[drawn]
        np.exp(down, out=down)
        down += 1
        np.divide(-weight[:, None], down, out=down)
        targets = _runs(np.concatenate([target, drawn]))
        self._descend(self.r, self.seen[0], _runs(context), up[:, None] * q + down @ n)
        self._descend(self.q, self.seen[1], targets, np.concatenate([up[:, None] * r, down.T @ r]))
        self._descend(self.b, self.seen[2], targets, np.concatenate([up, down.sum(axis=0)]))

    def learn_texts(self, texts: list[np.ndarray], end: int) -> None:
        """All pairs of the texts, each distinct pair once with its count as weight."""
        size = len(self.b)
        ids = np.concatenate(texts).astype(np.int64)
        before = np.concatenate([[end], ids[:-1]])  # a text starts after the end of another
        pairs, n = np.unique(before * size + ids, return_counts=True)
        context, target = pairs // size, pairs % size
        self.met_context += np.bincount(context, n, size)
        self.met_target += np.bincount(target, n, size)
        mixed = self.rng.permutation(len(pairs))
        step = min(_BATCH, max(_LEAST_BATCH, len(mixed) // 64))
        for some in np.split(mixed, range(step, len(mixed), step)):
            self.learn(context[some], target[some], n[some].astype(np.float32))


_SUMS = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])


def _train(batches: Iterator[pa.RecordBatch], model: Model, counts: np.ndarray, fan_in: int, turn: int = 0) -> Iterator[pa.RecordBatch]:
    """Parameters after the task's texts, times how often each symbol was met."""
    part = TaskContext.get().partitionId()
    copy, texts, size = Contrast(model, counts, seed=[part, turn]), [], 0
    end = len(counts) - 1
    for batch in batches:
        for ids in batch.column(0):
            texts.append(_from_bytes(ids.as_py()))
            size += len(texts[-1])
            if size >= _PAIRED_TOKENS:
                copy.learn_texts(texts, end)
                texts, size = [], 0
    if texts:
        copy.learn_texts(texts, end)
    if not copy.met_target.any():
        return
    as_context = np.column_stack([copy.r, copy.seen[0]]) * copy.met_context[:, None]
    as_target = np.column_stack([copy.q, copy.seen[1], copy.b, copy.seen[2]]) * copy.met_target[:, None]
    rows = np.column_stack([as_context, copy.met_context, as_target, copy.met_target])
    for block, low in enumerate(range(0, len(rows), _BLOCK)):
        sums = rows[low : low + _BLOCK].astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part // fan_in], pa.int32()), pa.array([sums], pa.binary())], schema=_SUMS)


def _add_up(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), "<f4").astype(np.float64) for x in table.column("sums"))
    return pa.Table.from_arrays([table.column("block")[:1], table.column("part")[:1], pa.array([total.astype("<f4").tobytes()], pa.binary())], schema=_SUMS)


def average(sums: DataFrame, model: Model) -> Model:
    """Weighted mean over tasks, in two steps, so no task adds up all of them."""
    kind = "block int, part int, sums binary"
    some = sums.groupBy("block", "part").applyInArrow(_add_up, kind)
    blocks = some.groupBy("block").applyInArrow(_add_up, kind).collect()  # one row per 1024 symbols
    d = model.contexts.shape[1]
    seen = np.ones((3, len(model.biases)), np.float32) if model.seen is None else model.seen.copy()
    mean = Model(model.contexts.copy(), model.targets.copy(), model.biases.copy(), seen)
    for row in blocks:
        rows = np.frombuffer(row.sums, "<f4").reshape(-1, 2 * d + 6)
        at = np.arange(row.block * _BLOCK, row.block * _BLOCK + len(rows))
        as_context, as_target = rows[:, d + 1] > 0, rows[:, -1] > 0
        context = rows[as_context, : d + 1] / rows[as_context, d + 1 : d + 2]
        target = rows[as_target, d + 2 : -1] / rows[as_target, -1:]
        mean.contexts[at[as_context]], mean.seen[0, at[as_context]] = context[:, :d], context[:, d]
        mean.targets[at[as_target]], mean.seen[1, at[as_target]] = target[:, :d], target[:, d]
        mean.biases[at[as_target]], mean.seen[2, at[as_target]] = target[:, d + 1], target[:, d + 2]
    return mean


def _normalisers(batches: Iterator[pa.RecordBatch], model: Model, contexts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Logarithm of the sum over all symbols, for blocks of contexts."""
    for batch in batches:
        for block in batch.column(0).to_pylist():
            some = model.contexts[contexts[block * _BLOCK : (block + 1) * _BLOCK]]
            logs = np.full(len(some), -np.inf)
            for low in range(0, len(model.biases), _SUMMED):
                targets, biases = model.targets[low : low + _SUMMED].T, model.biases[low : low + _SUMMED]
                for i in range(0, len(some), 128):
                    scores = some[i : i + 128] @ targets + biases
                    top = scores.max(axis=1)
                    scores -= top[:, None]
                    part = top + np.log(np.exp(scores, out=scores).sum(axis=1, dtype=np.float64))
                    logs[i : i + 128] = np.logaddexp(logs[i : i + 128], part)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([logs.tobytes()], pa.binary())], ["block", "logs"])


def normalisers(spark, model: Model, contexts: np.ndarray | None = None) -> np.ndarray:
    """Of the given contexts, or all; infinite for the others."""
    contexts = np.arange(len(model.biases)) if contexts is None else contexts
    blocks = -(-len(contexts) // _BLOCK)
    rows = spark.range(0, blocks, 1, blocks).mapInArrow(partial(_normalisers, model=model, contexts=contexts), "block bigint, logs binary")
    out = np.full(len(model.biases), np.inf)
    out[contexts] = np.concatenate([np.frombuffer(r.logs) for r in sorted(rows.collect())])
    return out


# --- scoring ------------------------------------------------------------------------


def token_log_probabilities(ids: np.ndarray, before: np.ndarray, model: Model, log_sums: np.ndarray) -> np.ndarray:
    scores = np.einsum("ij,ij->i", model.contexts.take(before, axis=0), model.targets.take(ids, axis=0)) + model.biases.take(ids)
    return scores.astype(np.float64) - log_sums.take(before)


def _score(batches: Iterator[pa.RecordBatch], model: Model, log_sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts are scored many at once; a long one in steps, so only one number per token is held."""
    end = len(log_sums) - 1

    def sums(texts):
        ids = np.concatenate(texts).astype(np.int64)
        before = np.append(end, ids[:-1])  # a text starts after the end of another
        scores = np.concatenate([token_log_probabilities(ids[i : i + _SCORED_TOKENS], before[i : i + _SCORED_TOKENS], model, log_sums) for i in range(0, len(ids), _SCORED_TOKENS)])
        scores[scores == -np.inf] = 0.0  # after a context without a normaliser
        return np.add.reduceat(scores, np.cumsum([0, *map(len, texts[:-1])]))

    for batch in batches:
        found, texts, size = [], [], 0
        for blob in batch.column(1):
            texts.append(_from_bytes(blob.as_py()))
            size += len(texts[-1])
            if size >= _SCORED_AT_ONCE:
                found.append(sums(texts))
                texts, size = [], 0
        if texts:
            found.append(sums(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.empty(0), *found]))], [ROW_ID, "symbol_score"])


def _symbol_scores(coded: DataFrame, model: Model, log_sums: np.ndarray) -> DataFrame:
    """Per text; tokens after a context without a normaliser are left out."""
    return coded.select(ROW_ID, "ids").mapInArrow(partial(_score, model=model, log_sums=log_sums), f"{ROW_ID} bigint, symbol_score double")


def train(coded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> tuple[Model, np.ndarray]:
    """The model that scores the judging texts best, and its normalisers.

    Without judging texts it is the last one.
    """
    counts = vocabulary.symbol_counts()
    lots = coded.filter("not held_out and not judges").select("ids").coalesce(max(1, round(np.sqrt(vocabulary.tokens / _COPY_TOKENS))))
    model, best, most, before = start(counts), None, -np.inf, -np.inf
    # numbers go by frequency; the class of other words and the end are the last two
    contexts = np.unique(np.append(np.arange(min(len(counts), _STOP_CONTEXTS)), [len(counts) - 2, len(counts) - 1]))
    for turn in range(rounds + 1):
        if turn:
            sums = lots.mapInArrow(partial(_train, model=model, counts=counts, fan_in=256, turn=turn), "block int, part int, sums binary")
            model = average(sums, model)
        log_sums = normalisers(coded.sparkSession, model, contexts)
        now = _symbol_scores(coded.filter("judges"), model, log_sums).agg(F.sum("symbol_score")).first()[0] or 0.0
        if now >= most:
            best, most = model, now
        if turn > 1 and now < before:
            break
        before = now
    return best, normalisers(coded.sparkSession, best)


def score(docs: DataFrame, modulus: int = 7, id_column="doc_id", text="text", top_words=TOP_WORDS, symbols=None, rounds=ROUNDS) -> DataFrame:
    """Score every text by a model of the texts that are not held out.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score``, both log10.
    """
    held_out = is_held_out(modulus, id_column)
    judges = is_held_out(modulus, id_column, JUDGES)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), judges.alias("judges"), F.col(text).cast("binary").alias("text"))
    counts = count_words(rows.filter(~F.col("held_out")).select("text"))
    vocabulary = frequent(counts, top_words, symbols)
    coded = rows.mapInArrow(partial(_code, vocabulary=vocabulary), _CODED)
    coded = land(coded.withColumn(ROW_ID, F.monotonically_increasing_id()), "coded")

    scored = _symbol_scores(coded, *train(coded, vocabulary, rounds))

    # words outside the broadcast table: rare by construction, so no word is a hot key
    others = counts.filter((F.col("n") < vocabulary.least) | (F.length("word") > TOP_WORD_BYTES))
    rare = coded.select(ROW_ID, F.explode("rare").alias("word")).join(others, "word")
    found = rare.groupBy(ROW_ID).agg(F.count(F.lit(1)).alias("n_found"), F.sum(F.log10(F.col("n") + 1)).alias("found_sum"))

    n_found, found_sum = F.coalesce("n_found", F.lit(0)), F.coalesce("found_sum", F.lit(0.0))
    slots = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1.0))
    other_slots = float(np.log10(vocabulary.other_slots()))
    result = coded.drop("ids", "rare").join(scored, ROW_ID).join(found, ROW_ID, "left")
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + n_found).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") + found_sum - F.col("n_tokens") * slots).alias("base_score"),
        (F.col("symbol_score") / float(np.log(10)) + F.col("other_sum") + found_sum - F.col("n_other") * other_slots).alias("score"),
    )
