"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character 1- to 3-grams over folded letters (anything that is no
letter is one space), hashed into ``2 ** FEATURE_BITS`` columns. Training is follow-the-
regularised-leader with an elastic net, in one pass order that depends on the data only; the
confidences are then calibrated by one temperature, fitted on documents kept out of training.

The classifier is fitted on at most ``rows_per_language`` documents of each language, those
with the smallest hash of their id: that many rows train in one task. Languages are assumed to
be few (thousands at most). Prediction reads every whole text.

Defined results
    null text, no letter    language ``und``, score 0
    null language           not used for training
    nothing to learn from   ``und``, score 0 for all
    very long text          read in pieces of a million characters, cut at a space
    ties                    the language that sorts first
    repeated rows           predicted one by one, alike
    empty table             empty result
    clashing extra columns  only the id, text and language are read
"""

import unicodedata
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import ROW_ID, identified, is_held_out, land

FEATURE_BITS = 17
ROWS_PER_LANGUAGE = 500
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 0.1, 1e-4, 1e-4
UNKNOWN = "und"

_DUMMY = 1 << FEATURE_BITS  # the column of grams that would cross the end of a text
_PIECE = 1_000_000
_LOT = 500_000
_LAST_LETTER = 0x32400  # no letters above this code point


# --- features -----------------------------------------------------------------------


@cache
def _fold() -> np.ndarray:
    """Code point to folded letter, or to a space."""
    table = np.full(_LAST_LETTER + 1, 32, np.uint32)
    for point in range(_LAST_LETTER):
        if unicodedata.category(chr(point)).startswith("L"):
            lower = chr(point).lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def pieces_of(text: str) -> Iterator[str]:
    while len(text) > _PIECE:
        cut = text.rfind(" ", _PIECE // 2, _PIECE)
        cut = _PIECE if cut < 0 else cut
        yield text[:cut]
        text = text[cut:]
    yield text


def gram_columns(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(columns of the 1-, 2- and 3-grams at each place, first place of each text, letters).

    Each text gets a space on both sides; grams that begin with the one behind it do not count,
    so a text has the same grams wherever it stands.
    """
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), "<u4")
    folded = _fold()[np.minimum(points, _LAST_LETTER)]
    letter = folded != 32
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1]
    ends = np.cumsum([len(t) + 1 for t in texts])  # place of the space after each text
    begins = np.concatenate([[0], ends[:-1]])  # and of the one before it
    # the space between two texts belongs to both; the later one starts a place further
    kept[ends] = True
    place = np.cumsum(kept) - 1
    chars = folded[kept].astype(np.uint64)
    first, last = place[begins], place[ends]
    columns = []
    for n in (1, 2, 3):
        code = chars[: len(chars) - n + 1] + np.uint64(n << 24)
        for j in range(1, n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + chars[j : len(chars) - n + 1 + j]
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        column = np.full(len(chars), _DUMMY, np.int64)
        column[: len(code)] = (code >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        for j in range(1, n - 1):  # grams that start inside a text and end behind its space
            column[last - j] = _DUMMY
        column[last[-1]] = _DUMMY  # the space after a text counts for the next one, if at all
        columns.append(column)
    letters = np.add.reduceat(np.append(letter[kept], False).astype(np.int64), first)
    return columns, first, letters


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(columns, term frequencies) of one text."""
    counts: dict[int, int] = {}
    for piece in pieces_of(text):
        columns, _, _ = gram_columns([piece])
        seen, n = np.unique(np.concatenate(columns), return_counts=True)
        if not counts and len(text) <= _PIECE:
            used = seen < _DUMMY
            return seen[used], n[used] / max(1, n[used].sum())
        for c, k in zip(seen.tolist(), n.tolist()):
            if c < _DUMMY:
                counts[c] = counts.get(c, 0) + k
    total = max(1, sum(counts.values()))
    return np.array(sorted(counts), np.int64), np.array([counts[c] / total for c in sorted(counts)])


# --- training -----------------------------------------------------------------------


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class FollowTheLeader:
    """FTRL-proximal for the weights of all classes; untouched weights are exactly zero."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, rows, values, target) -> None:
        w = self.weights(rows)
        p = softmax(values @ w)
        p[target] -= 1
        g = values[:, None] * p[None, :]
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[rows] += g * g


def fit_temperature(logits: np.ndarray, targets: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    if not len(targets):
        return 1.0

    def loss(log_t):
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(targets)), targets], 1e-300)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


_BIAS = _DUMMY  # the bias is a feature of its own, in the row of the dummy column while training


def fit(texts: list[str], languages: list[str], spare: list[bool]) -> dict:
    """Model of the given texts; the spare ones only set the temperature."""
    names = sorted(set(languages))
    target = np.array([names.index(x) for x in languages], np.int64)
    documents = [_document(t) for t in texts]
    training = [i for i, s in enumerate(spare) if not s]
    frequency = np.zeros(_DUMMY)
    for i in training:
        frequency[documents[i][0]] += 1
    idf = np.log((1 + len(training)) / (1 + frequency)) + 1
    leader = FollowTheLeader(_DUMMY + 1, len(names))

    def example(i):
        columns, tf = documents[i]
        values = tf * idf[columns] * 10
        return np.append(columns, _BIAS), np.append(values, 0.1)

    for _ in range(EPOCHS):
        for i in training:
            leader.update(*example(i), target[i])
    weights = leader.weights()
    left = [i for i, s in enumerate(spare) if s]
    logits = np.array([example(i)[1] @ weights[example(i)[0]] for i in left]).reshape(-1, len(names))
    table = (weights[:_DUMMY] * idf[:, None] * 10).astype("<f4")
    return {
        "names": names,
        "table": table,
        "bias": weights[_BIAS] * 0.1,
        "temperature": fit_temperature(logits, target[left]),
    }


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["order"], r["text"]))
    if not rows:
        return
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows], [r["order"] % 5 == 0 for r in rows])
    used = np.flatnonzero(model["table"].any(axis=1))
    cells = [model["names"], used.tolist(), model["table"][used].tobytes(), model["bias"].tolist(), model["temperature"]]
    kinds = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.float64()), pa.float64()]
    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], ["names", "used", "weights", "bias", "temperature"])


def train(docs: DataFrame, id_column="doc_id", text="text", language="lang", rows_per_language=ROWS_PER_LANGUAGE) -> dict | None:
    """Fit on a bounded sample of the labelled documents; None if there are none.

    The sample is chosen on ids and languages alone; texts are read for the chosen rows only.
    """
    docs = identified(docs)
    labelled = docs.filter(F.col(language).isNotNull())
    order = F.xxhash64(F.col(id_column).cast("string"), ROW_ID)
    narrow = labelled.select(ROW_ID, F.col(language).alias("lang"), order.alias("order"))
    # the order is an even hash: its lowest share holds four times the rows wanted, however many tasks
    # there are, and one row per language is joined to find that share
    counts = narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    place = F.col("order") / F.lit(2.0**64) + 0.5
    narrow = narrow.join(F.broadcast(counts), "lang").filter(place * F.col("rows") <= 4 * rows_per_language).drop("rows")
    first = W.partitionBy("lang").orderBy("order", ROW_ID)
    chosen = land(narrow.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= rows_per_language).drop("n"), "sample")
    texts = docs.select(ROW_ID, F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), ROW_ID).select("text", "lang", "order")
    made = land(
        sample.repartition(1).mapInArrow(_train, "names array<string>, used array<int>, weights binary, bias array<double>, temperature double"),
        "model",
    ).first()
    return made and made.asDict()


# --- prediction ---------------------------------------------------------------------


def _table(model: dict) -> np.ndarray:
    classes = len(model["names"])
    table = np.zeros((_DUMMY + 1, classes), np.float32)
    table[np.array(model["used"], np.int64)] = np.frombuffer(model["weights"], "<f4").reshape(-1, classes)
    return table


def _scores(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum of weights, number of grams, number of letters) of each text."""
    columns, first, letters = gram_columns(texts)
    total = table[columns[0]]
    used = (columns[0] < _DUMMY).astype(np.int64)
    for column in columns[1:]:
        total += table[column]
        used += column < _DUMMY
    return np.add.reduceat(total, first, axis=0, dtype=np.float64), np.add.reduceat(used, first), letters


def _lots(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    owners, lot, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces_of(text):
            if size + len(piece) > _LOT and lot:
                yield owners, lot
                owners, lot, size = [], [], 0
            owners.append(i)
            lot.append(piece)
            size += len(piece)
    if lot:
        yield owners, lot


def _predict(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    table, names, bias = _table(model), np.array([*model["names"]], object), np.array(model["bias"])
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        total, grams, letters = np.zeros((len(texts), len(names))), np.zeros(len(texts)), np.zeros(len(texts))
        for owners, lot in _lots(texts):
            sums, used, found = _scores(lot, table)
            np.add.at(total, owners, sums)
            np.add.at(grams, owners, used)
            np.add.at(letters, owners, found)
        p = softmax((total / np.maximum(grams, 1)[:, None] + bias) / model["temperature"])
        best = p.argmax(axis=1) if len(texts) else np.zeros(0, np.int64)
        known = letters > 0
        lang = np.where(known, names[best], UNKNOWN)
        score = np.where(known, p.max(axis=1, initial=0), 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, modulus: int = 4, id_column="doc_id", text="text", language="lang", rows_per_language=ROWS_PER_LANGUAGE) -> DataFrame:
    """Train on the documents that are not held out, predict all of them.

    Returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.
    """
    held_out = is_held_out(modulus, id_column)
    model = train(docs.filter(~held_out), id_column, text, language, rows_per_language)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(partial(_predict, model=model), "doc_id bigint, held_out boolean, lang_pred string, score double")
