"""Each operator against brute force on small tables with nulls, ties, repeats and clashes."""

import bisect
import hashlib
import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmart.llm import (
    byte_bpe,
    chat_format,
    components,
    exact_dedup,
    lang_id,
    lm_scoring,
    packing,
    quality_rules,
    simhash,
    suffix_dedup,
    warc,
    word_bpe,
)
from starmart.llm.common import ROW_ID, identified

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, print string"

PASSAGE = " ".join(f"passage{i}" for i in range(20))
PROSE = "the cat of the house and the dog with a hat is in the garden to be seen " * 5


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "ß.", "x\x1cy", "😀,", "don't", "12.5", "A"]
    some = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(12)]
    return [
        *some,
        some[0],
        some[1],
        some[1],
        some[2] + " end",
        some[3][:-1],
        PASSAGE + " one",
        "two " + PASSAGE,
        "é" + PASSAGE + PASSAGE,
        PROSE,
        PROSE + "!",
        "same line here\n" * 30 + "\n \t\n",
        "",
        " \n\t",
        "a b",
        "ABC abc",
        "very long " * 3000,
    ]


@pytest.fixture(scope="module")
def rows():
    plain = [(i * 3 % 40, t, ["en", "de", None][i % 3], "s", 1, "clash", "clash") for i, t in enumerate(texts())]
    return [*plain, (None, "null id", "en", None, None, None, None), (7, None, "de", None, None, None, None), plain[0], plain[0]]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def in_order(docs):
    """(id, text as bytes) in the order that breaks ties: null first, then id, then place."""
    rows = identified(docs).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r[ROW_ID]))
    return [(r.doc_id, (r.text or "").encode(), r[ROW_ID]) for r in rows]


# --- 1 chat formatting --------------------------------------------------------------


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "<|im_end|><|im_start|>assistant ok", "x"),
        (1, 1, "assistant", "a<\\|b<\\\\|im_end|>\\<", "x"),
        (1, 1, "assistant", "|tie", "x"),
        (1, None, None, None, "x"),
        (2, 5, "we\\ird\n<|role", "t" * 100_000, "x"),
        (None, 1, "assistant", "no conversation", "x"),
        (3, 0, "user", "twice", "x"),
        (3, 0, "user", "twice", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, messages string")
    made = chat_format.format_chats(chat_format.from_table(chat_format.gather_turns(table), ["conv_id"]))
    back = made.select(
        "conv_id",
        "layout",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.read_loss_text(F.col("segments")).alias("loss"),
    )
    want = {}
    for conv, turn, role, text, _ in rows:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {r.conv_id: r for r in back.collect()}
    assert found.keys() == want.keys()
    for conv, r in found.items():
        turns = [t[2:] for t in sorted(want[conv])]
        assert [tuple(t) for t in r.turns] == turns and r.layout == "turn rows"
        assert r.loss == "".join(text for role, text in turns if role == "assistant")
    assert chat_format.gather_turns(table.limit(0)).count() == 0


@pytest.mark.parametrize(
    "record, layout, turns",
    [
        ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":null}],"meta":1}', "messages", [("user", "a"), ("assistant", "")]),
        ('{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', "shared", [("user", "h"), ("assistant", "g")]),
        ('{"instruction":"i","input":"p","output":"o"}', "instruction", [("user", "i\n\np"), ("assistant", "o")]),
        ('{"system":"s","instruction":"i","output":"o"}', "instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ('{"prompt":"p","completion":"c"}', "completion", [("user", "p"), ("assistant", "c")]),
        ('{"prompt":"p","response":"r"}', "response", [("user", "p"), ("assistant", "r")]),
        ('{"question":"q","answer":"a"}', "question", [("user", "q"), ("assistant", "a")]),
        ('{"text":"t"}', None, []),
        ("no json", None, []),
        (None, None, []),
    ],
)
def test_layouts(spark, record, layout, turns):
    table = spark.createDataFrame([(record,)], "j string")
    made = chat_format.format_chats(chat_format.from_json(table, "j", []))
    row = made.select("layout", chat_format.read_turns(F.col("formatted")).alias("turns")).first()
    assert row.layout == layout and [tuple(t) for t in row.turns] == turns


def test_fingerprints_are_distinct():
    prints = [p for layout in chat_format.LAYOUTS for p in layout.fingerprints()]
    assert len(prints) == len(set(prints))


# --- 2 language model ---------------------------------------------------------------


def test_lm_base_and_counts(docs, rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    words = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, *_ in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))
        want.append((str(i), held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(base, 6)))
    for top_words, symbols in ((1 << 17, 1 << 14), (20, 12), (0, 2)):
        found = lm_scoring.score(docs, top_words=top_words, symbols=symbols).collect()
        have = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found]
        assert sorted(have) == sorted(want)
        assert all(r.score < 0 for r in found)


def test_lm_normalised_and_better_than_unigram():
    rng = np.random.default_rng(0)
    follows = rng.permutation(20)  # a strict order of words, which a unigram model cannot know
    ids, at = [], 0
    for _ in range(20000):
        ids.append(at)
        at = follows[at] if rng.random() < 0.9 else rng.integers(20)
    text = np.array([*ids, 21], "<u2")
    counts = np.bincount(text, minlength=22).astype(float)
    first = lm_scoring.start(counts)
    copy = lm_scoring.Contrast(first, counts)
    for _ in range(100):
        copy.learn_texts([text], 21)
    model = lm_scoring.Model(copy.r, copy.q, copy.b)
    scores = model.contexts @ model.targets.T + model.biases
    sums = np.log(np.exp(scores.astype(float)).sum(axis=1))
    every = np.array([lm_scoring.token_log_probabilities(np.arange(22), np.full(22, h), model, sums) for h in range(22)])
    assert np.allclose(np.exp(every).sum(axis=1), 1, atol=1e-4)
    now, before = text[1:].astype(int), text[:-1].astype(int)
    unigram = np.log(counts / counts.sum())[now].mean()
    assert lm_scoring.token_log_probabilities(now, before, model, sums).mean() > unigram + 0.3


def test_lm_score_beats_base_on_held_out_texts_with_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_COPY_TOKENS", 1000, raising=False)
    rng, word, rows = random.Random(11), 0, []
    follow = [rng.sample(range(200), 4) for _ in range(200)]
    for i in range(400):
        text = []
        for _ in range(200):
            text.append(f"w{word}")
            word = rng.choice(follow[word])
        rows.append((i, " ".join(text)))
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8).write.parquet(f"{tmp_path}/docs")
    many = spark.read.option("maxPartitionBytes", "1k").parquet(f"{tmp_path}/docs")
    held = [r for r in lm_scoring.score(many).collect() if r.held_out]
    assert len(held) > 30
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.2, gain


def test_lm_held_out_texts_decide_nothing(spark, tmp_path):
    """Other held-out texts leave all other scores as they are."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(rng.choices(words, range(80, 0, -1), k=40))) for i in range(400)]
    noise = [(i, " ".join(f"x{rng.randrange(900)}" for _ in range(50)) if zlib.crc32(str(i).encode()) % 7 == 2 else t) for i, t in rows]
    scores = []
    for name, some in (("a", rows), ("b", noise)):
        spark.createDataFrame(some, "doc_id bigint, text string").repartition(3, "doc_id").write.parquet(str(tmp_path / name))
        found = lm_scoring.score(spark.read.parquet(str(tmp_path / name))).collect()
        scores.append({r.doc_id: (r.score, r.base_score) for r in found if not r.held_out})
    assert len(scores[0]) > 300 and scores[0].keys() == scores[1].keys()
    for doc, now in scores[0].items():
        assert now == pytest.approx(scores[1][doc], rel=1e-9)


def test_lm_symbols_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LEAST_SYMBOLS", 4, raising=False)
    monkeypatch.setattr(lm_scoring, "SYMBOLS_PER_ROOT", 2, raising=False)
    sizes = []
    for n in (100, 10_000):
        rows = [(f"w{i}".encode(), 1 + n // (i + 1)) for i in range(n // 20)] + [(b"", 10)]
        vocabulary = lm_scoring.frequent(spark.createDataFrame(rows, "word binary, n bigint"), top_words=3)
        assert vocabulary.symbols == max(4, int(2 * np.sqrt(vocabulary.tokens)))
        assert vocabulary.named <= len(vocabulary.words)
        sizes.append(vocabulary.named)
    assert sizes[1] > 5 * sizes[0]
    wide = np.array([0, 1, 65_535, 65_536, 1_000_000])
    assert lm_scoring._from_bytes(lm_scoring._to_bytes(wide)).tolist() == wide.tolist()


def test_lm_normalisers_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_SUMMED", 7)
    rng = np.random.Generator(np.random.PCG64(2))
    model = lm_scoring.Model(*(rng.normal(0, 1, shape).astype(np.float32) for shape in ((30, 3), (30, 3), 30)))
    want = np.log(np.exp(model.contexts @ model.targets.T + model.biases).sum(axis=1))
    assert np.allclose(lm_scoring.normalisers(spark, model), want, atol=1e-5)
    some = lm_scoring.normalisers(spark, model, np.array([2, 29]))
    assert np.flatnonzero(some != np.inf).tolist() == [2, 29] and np.allclose(some[[2, 29]], want[[2, 29]], atol=1e-5)


_LM_TEXTS = [bytes([i]) + b"a" + bytes([i]) + b"B" + bytes([i]) for i in range(256)] + [None, b"", b" ", b"A a the\xc3\x89 the", b"\xff\xfe A\x00"] + [b"the x%d " % (i % 50) * (i % 7) for i in range(500)]


def _lm_batches(texts, kind, size):
    plain = [pa.array([None] * len(texts), k) for k in (pa.int64(), pa.bool_(), pa.bool_())]
    whole = pa.RecordBatch.from_arrays([*plain, pa.array(texts, kind)], ["doc_id", "held_out", "judges", "text"])
    return [whole.slice(i, size) for i in range(0, len(texts), size)]


@pytest.mark.parametrize("pieces", (1 << 24, 40))
@pytest.mark.parametrize("kind", (pa.binary(), pa.large_binary()))
def test_lm_words_as_plainly_split(kind, pieces, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_SPLIT_BYTES", pieces, raising=False)
    monkeypatch.setattr(lm_scoring, "_COUNTED_WORDS", 100 if pieces == 40 else 400_000)
    split = [(t or b"").lower().split() for t in _LM_TEXTS]
    want = Counter(w for words in split for w in words)
    found = Counter()
    for batch in lm_scoring._count(b.select(["text"]) for b in _lm_batches(_LM_TEXTS, kind, 300)):
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            found[word] += n
    assert found == want | Counter({b"": len(_LM_TEXTS)})

    known = [w for w, n in want.most_common(60)]
    vocabulary = lm_scoring.Vocabulary(known, np.array([want[w] for w in known]), 1, want.total() + len(split), len(want) + 1, len(split), 32)
    rows = [r for b in lm_scoring._code(iter(_lm_batches(_LM_TEXTS, kind, 300)), vocabulary) for r in b.to_pylist()]
    assert len(rows) == len(split)
    for row, words in zip(rows, split):
        places = [known.index(w) if w in known else 60 for w in words]
        log = [math.log10(want[w] + 1) if w in known else 0.0 for w in words]
        assert lm_scoring._from_bytes(row["ids"]).tolist() == [p if p < 30 else 30 for p in places] + [31]
        assert row["rare"] == [w for w in words if w not in known]
        assert (row["n_tokens"], row["n_known"], row["n_other"]) == (len(words) + 1, sum(p < 60 for p in places) + 1, sum(p >= 30 for p in places))
        assert row["base_sum"] == pytest.approx(sum(log) + math.log10(len(split) + 1))
        assert row["other_sum"] == pytest.approx(sum(x for x, p in zip(log, places) if p >= 30))


def test_lm_words_and_texts_take_no_call_each():
    """Words are split, counted and numbered, and texts scored, many to a call."""

    def calls(rows):
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            out = list(rows)
        finally:
            sys.setprofile(None)
        return n, out

    vocabulary = lm_scoring.Vocabulary([b"a", b"b"], np.array([20_000, 10_000]), 1, 31_000, 3, 1000, 4)
    short, long = [b"a b a"] * 1000, [b"a b a " * 10_000]
    assert calls(lm_scoring._count(b.select(["text"]) for b in _lm_batches(short, pa.binary(), 1000)))[0] < 1000
    n, coded = calls(lm_scoring._code(iter(_lm_batches(long, pa.binary(), 1)), vocabulary))
    assert n < 1000
    assert len(lm_scoring._from_bytes(coded[0].column("ids")[0].as_py())) == 30_001
    coded = [*lm_scoring._code(iter(_lm_batches(short, pa.binary(), 1000)), vocabulary)][0]
    texts = pa.RecordBatch.from_arrays([pa.array(range(1000)), coded.column("ids")], ["id", "ids"])
    assert calls(lm_scoring._score(iter([texts]), lm_scoring.start(vocabulary.symbol_counts()), np.zeros(4)))[0] < 15_000


def test_lm_scores_many_texts_as_one_by_one(monkeypatch):
    monkeypatch.setattr(lm_scoring, "_SCORED_TOKENS", 50)
    monkeypatch.setattr(lm_scoring, "_SCORED_AT_ONCE", 70, raising=False)
    rng = np.random.Generator(np.random.PCG64(4))
    model = lm_scoring.Model(*(rng.normal(0, 1, shape).astype(np.float32) for shape in ((30, 3), (30, 3), 30)))
    log_sums = np.where(np.arange(30) % 4 == 1, np.inf, rng.normal(3, 1, 30))
    texts = [np.append(rng.integers(0, 29, n), 29) for n in (0, 1, 3, 0, 40, 400, 2, 0, 90, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([lm_scoring._to_bytes(t) for t in texts])], ["id", "ids"])
    found = [x for b in lm_scoring._score(iter([batch, batch.slice(0, 0)]), model, log_sums) for x in b.column(1).to_pylist()]
    pairs = [list(zip([29, *t[:-1]], t)) for t in texts]
    want = [sum(float(model.contexts[h] @ model.targets[w] + model.biases[w]) - log_sums[h] for h, w in p if h % 4 != 1) for p in pairs]
    assert found == pytest.approx(want, rel=1e-5)


def test_lm_steps_add_up_equal_rows():
    rng = np.random.Generator(np.random.PCG64(6))
    model = lm_scoring.start(np.arange(40.0, 10, -1))
    model.targets[:] = rng.normal(0, 1, model.targets.shape)
    copy, plain = (lm_scoring.Contrast(model, np.arange(40.0, 10, -1), noise=5, seed=3) for _ in range(2))
    context, target, weight = rng.integers(0, 30, 90), rng.integers(0, 30, 90), rng.integers(1, 5, 90).astype(np.float32)
    copy.learn(context, target, weight)

    drawn = np.searchsorted(plain.cumulative, plain.rng.random(5))
    share = np.log(5 * (np.arange(40.0, 10, -1) + 1) / (np.arange(40.0, 10, -1) + 1).sum())
    gradient = [np.zeros((30, 8)), np.zeros((30, 8)), np.zeros(30)]
    for h, w, n in zip(context, target, weight):
        for word, real in [(w, True), *((d, False) for d in drawn)]:
            odds = math.exp(model.contexts[h] @ model.targets[word] + model.biases[word] - share[word])
            up = n / (1 + odds) if real else -n * odds / (1 + odds)
            gradient[0][h] += up * model.targets[word]
            gradient[1][word] += up * model.contexts[h]
            gradient[2][word] += up
    for table, first, total in zip((copy.r, copy.q, copy.b), (model.contexts, model.targets, model.biases), gradient):
        square = (total * total).mean(axis=1, keepdims=True) if total.ndim > 1 else total * total
        assert np.allclose(table, first + lm_scoring.LEARNING_RATE * total / np.sqrt(1 + square), atol=1e-5)


def test_lm_empty(empty):
    assert lm_scoring.score(empty).count() == 0


# --- 3 archives ---------------------------------------------------------------------


def test_warc(spark):
    big, other = "<p>" + "x" * 2000, "é" * 700
    rows = [(1, "http://a/ \r\nb", big, 0), (2, None, big, 0), (9, "u", big, 0), (9, "u", big, 0), (3, "u", "small", 0), (4, "u", "small", 0), (5, "u", None, 0), (None, "u", other, 0), (6, "u", other, 0), (7, "u", "z" * 3_000_000, 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int").repartition(3)
    index = warc.write_archives(pages, frame_bytes=4000)
    want = []
    for i, _, html, _ in rows:
        body = (html or "").encode()
        same = [j for j, _, h, _ in rows if (h or "").encode() == body and j is not None]
        target = max(same) if len(body) >= 1000 else i
        refers = None if target == i else target
        want.append((i, "response" if refers is None else "revisit", refers, len(body), hashlib.sha1(body).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    for found in (warc.read_archives(index), warc.fetch(index)):
        have = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in found.collect()]
        assert sorted(have, key=key) == sorted(want, key=key)
    for archive in {r.archive for r in index.collect()}:
        frames = {(r.frame_offset, r.frame_size) for r in index.collect() if r.archive == archive}
        assert set(warc.seek_table(archive)) == frames
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


# --- 4 exact dedup ------------------------------------------------------------------


def test_exact_dedup(spark, docs, empty):
    ordered = in_order(docs)
    last = {text: (doc, row) for doc, text, row in ordered}
    sizes = Counter(text for _, text, _ in ordered)
    index = exact_dedup.new_index(spark)
    found = {r[ROW_ID]: r for r in index.add_batch(docs, "one").collect()}
    for doc, text, row in ordered:
        r = found[row]
        assert (r.doc_id, r.keep_id, r.group_size, r.kept) == (doc, last[text][0], sizes[text], row == last[text][1])
        assert bytes(r.digest) == hashlib.sha256(text).digest()
    assert index.read().count() == len(sizes)
    reopened = exact_dedup.DigestIndex(spark, index.path, index.buckets)
    again = reopened.add_batch(docs, "two").collect()
    assert not any(r.kept for r in again) and index.read().count() == len(sizes)
    assert exact_dedup.drop_copies(docs, reopened).count() == 0
    kept = exact_dedup.drop_copies(docs, exact_dedup.new_index(spark))
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    assert exact_dedup.drop_copies(empty, reopened).count() == 0


@pytest.mark.parametrize("broken", ["before", "after"])
def test_a_batch_can_be_added_again(spark, docs, broken, monkeypatch):
    """A run that dies before or after its digests are written is repeated with equal rows."""
    index, half = exact_dedup.new_index(spark), docs.filter("doc_id % 2 = 0")
    index.add_batch(docs.filter("doc_id % 3 = 0"), "earlier")
    want = sorted(map(str, index.add_batch(half, "now").collect()))
    held = sorted(map(str, index.read().collect()))
    write = exact_dedup.DigestIndex.write

    def dies(self, batch, digests):
        if broken == "after":
            write(self, batch, digests)
        raise RuntimeError("lost")

    monkeypatch.setattr(exact_dedup.DigestIndex, "write", dies)
    with pytest.raises(RuntimeError):
        index.add_batch(half, "now")
    monkeypatch.undo()
    assert sorted(map(str, index.add_batch(half, "now").collect())) == want
    assert sorted(map(str, index.read().collect())) == held


def test_batches_are_decided_by_the_index(spark, docs, monkeypatch):
    """Later batches meet earlier ones; ids of both signs, null ids, equal ids."""
    shifted = docs.withColumn("doc_id", F.expr("doc_id - 20"))
    ordered = in_order(shifted)
    last = {text: (doc, row) for doc, text, row in ordered}
    sizes = Counter(text for _, text, _ in ordered)
    for batches in (1, 2, 5):
        index = exact_dedup.new_index(spark)
        found = {r[ROW_ID]: r for r in exact_dedup.deduplicate(shifted, index, batches=batches).collect()}
        assert len(found) == len(ordered)
        for doc, text, row in ordered:
            r = found[row]
            assert (r.doc_id, r.keep_id, r.group_size, r.kept) == (doc, last[text][0], sizes[text], row == last[text][1])
        assert len({r.batch for r in index.read().collect()}) == batches
    with pytest.raises(ValueError):
        index.add_batch(docs, "a'b")


def test_rows_keep_their_numbers_when_scans_are_cut_anew(spark, tmp_path):
    """The cores change between the steps of each operator, and with them the cut of the files."""
    rng, cores = random.Random(4), [1, 7, 2, 16, 3]
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(60)]
    rows = [(i, rng.choice(base) + rng.choice(["", "", " end"]), "s", 1, "k", "p") for i in range(600)]
    rows = [(i, text, "en" if "w1" in text.split(" ")[0] else "de", *others) for i, text, *others in rows]
    path = str(tmp_path / "d")
    spark.createDataFrame(rows, DOCS).repartition(12).write.parquet(path)

    def results():
        docs = spark.read.parquet(path)
        found = [
            exact_dedup.drop_copies(docs, exact_dedup.new_index(spark)).collect(),
            simhash.drop_near_copies(docs).collect(),
            suffix_dedup.cut_repeats(docs).collect(),
            [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 6)) for r in lang_id.identify(docs).collect()],
        ]
        return [sorted(map(str, f)) for f in found]

    want, land = results(), exact_dedup.land
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    turn = 0

    def land_and_change(df, name):
        nonlocal turn
        turn += 1
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(cores[turn % len(cores)]))
        return land(df, name)

    with pytest.MonkeyPatch.context() as patch:
        for module in (exact_dedup, simhash, suffix_dedup, lang_id):
            patch.setattr(module, "land", land_and_change)
        try:
            again = results()
            assert [[x for x in zip(a, b) if x[0] != x[1]][:3] for a, b in zip(again, want)] == [[], [], [], []] and turn > 10
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_identified_writes_what_is_no_scan(spark, docs):
    numbered = identified(docs.filter("doc_id > 3").select("doc_id", "text"))
    assert "_metadata" in numbered._jdf.queryExecution().analyzed().toString()
    rows = {r[ROW_ID]: r.doc_id for r in identified(docs).collect()}
    assert len(rows) == docs.count() and all(rows[r[ROW_ID]] == r.doc_id for r in numbered.collect())
    for other in (docs.union(docs), docs.withColumn("e", F.explode(F.array(F.lit(1), F.lit(2)))), docs.groupBy("text").count()):
        found = identified(other)
        assert found.columns == [*other.columns, ROW_ID] and found.select(ROW_ID).distinct().count() == other.count()


def test_index_is_read_without_a_shuffle(spark, docs):
    index = exact_dedup.new_index(spark)
    index.add_batch(docs, "one")
    index.add_batch(docs, "two")
    batch = spark.range(10).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    plan = batch.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


# --- 5 quality rules ----------------------------------------------------------------


def test_quality_counts(docs):
    for r in quality_rules.verdicts(quality_rules.measure(docs)).collect():
        text = r.text or ""
        words = text.encode().split()
        windows = list(zip(words, words[1:], words[2:]))
        often = Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars) == (len(words), sum(len(w.decode()) for w in words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert r.kept == (not r.base_failed and not r.failed_rules)


def test_quality_rules_judge(spark, docs, empty):
    good = " ".join(f"the{i} of" for i in range(60))
    bad = {"symbols": "the of## " * 0 + " ".join(f"the of{i}##" for i in range(60)), "stop_words": " ".join(f"zebra{i}" for i in range(80))}
    table = spark.createDataFrame([("good", good), *bad.items()], "name string, text string")
    found = {r.name: r for r in quality_rules.verdicts(quality_rules.measure(table)).collect()}
    assert found["good"].kept and not found["symbols"].kept and "symbols" in found["symbols"].failed_rules
    assert found["stop_words"].failed_rules == ["stop_words"]
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and quality_rules.keep_good(empty).count() == 0


# --- 6 byte-level BPE ---------------------------------------------------------------


@pytest.mark.parametrize("chunk_bytes", [200, 1 << 23])
def test_byte_bpe(docs, rows, chunk_bytes):
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe._ranks(BYTE_VOCABULARY), special_tokens={})
    found = byte_bpe.encode_and_decode(docs, BYTE_VOCABULARY, public_tokenizers.PATTERN, chunk_bytes=chunk_bytes).collect()
    have = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.n_tokens, bytes(r.decoded)) for r in found)
    want = Counter()
    for i, t, *_ in rows:
        ids = tuple(whole.encode_ordinary(t or ""))
        want[(i, ids, len(ids), (t or "").encode())] += 1
    assert have == want


def test_byte_bpe_empty(empty):
    assert byte_bpe.encode_and_decode(empty, BYTE_VOCABULARY, public_tokenizers.PATTERN).count() == 0


# --- 7 suffix-array dedup -----------------------------------------------------------


@pytest.mark.parametrize("hot", [0, 10_000])
def test_suffix_dedup(docs, hot):
    seen, want = set(), Counter()
    for doc, text, _ in in_order(docs):
        gone = bytearray(len(text))
        for i in range(len(text) - 99):
            window = text[i : i + 100]
            if window in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        want[(doc, len(text), sum(gone), spans, bytes(c for c, g in zip(text, gone) if not g))] += 1
    found = suffix_dedup.remove_repeats(docs, hot=hot).collect()
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == want


def test_removable_copies_are_dealt_to_all_buckets_and_not_held():
    rng, buckets = random.Random(3), 64
    text = bytes(rng.randrange(97, 123) for _ in range(200_000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(12), pa.int64()), pa.array([text] * 12, pa.binary()), pa.array(range(12), pa.int64())], ["doc", "text", ROW_ID])
    sent = list(suffix_dedup._local_segments(iter([batch]), 100, buckets))
    copies, first = Counter(), Counter()
    for m in (m for b in sent for m in b.to_pylist()):
        (copies if m["removed"] else first)[m["bucket"]] += len(suffix_dedup._unpack(m["rows"], suffix_dedup._SEGMENT))
    assert sum(copies.values()) == 11 * sum(first.values())
    assert len(copies) > buckets / 4 and max(copies.values()) < sum(copies.values()) / 4
    assert len(first) == buckets and max(first.values()) < 2 * sum(first.values()) / buckets

    read = 0

    def stream():
        nonlocal read
        for b in (b for b in sent if b.column("removed")[0].as_py()):
            read += 1
            yield b

    settled, rows = suffix_dedup._settle(stream(), 10), 0
    for n in range(1, 4):
        rows += next(settled).num_rows
        assert read == n
    assert rows + sum(b.num_rows for b in settled) == sum(copies.values())


def test_previous_factors():
    rng = np.random.default_rng(3)
    for _ in range(30):
        windows = rng.integers(0, 3, (rng.integers(1, 40), 6)).astype(np.uint8)
        order = rng.permutation(len(windows))
        found = suffix_dedup.previous_factors(windows, order)
        for i, w in enumerate(windows):
            earlier = [np.flatnonzero(np.append(w != windows[j], True))[0] for j in range(len(windows)) if order[j] < order[i]]
            assert found[i] == max(earlier, default=0)


def test_cut_keeps_columns(docs, empty):
    cut = suffix_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert suffix_dedup.cut_repeats(empty).count() == 0


# --- 8 SimHash ----------------------------------------------------------------------


def brute_print(text):
    words = text.lower().split()
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket_rows", [1, 1000])
def test_simhash_components(docs, bucket_rows):
    ordered = in_order(docs)
    prints = [brute_print(text) for _, text, _ in ordered]
    label = list(range(len(ordered)))
    for _ in ordered:
        for i, p in enumerate(prints):
            label[i] = min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2)
    found = {r[ROW_ID]: r for r in simhash.near_duplicates(docs, bucket_rows=bucket_rows).collect()}
    for i, (doc, _, row) in enumerate(ordered):
        same = [ordered[j][0] for j in range(len(ordered)) if label[j] == label[i] and ordered[j][0] is not None]
        assert found[row].print % (1 << 64) == prints[i]
        assert (found[row].doc_id, found[row].component_id) == (doc, min(same, default=None))
    assert sum(r.kept for r in found.values()) == len(set(label))


@pytest.mark.parametrize("plan, bucket_rows", [(None, 3), ([(1, 2)], 10**6), ([(2, 1), (2, 0)], 3)])
def test_links_find_every_pair(spark, monkeypatch, plan, bucket_rows):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(3):
            prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = sorted(prints)
    if plan:
        sizes = [64 * i // len(plan) for i in range(len(plan) + 1)]
        fixed = [(list(range(a, b)), t) for (_, t), a, b in zip(plan, sizes, sizes[1:])]
        monkeypatch.setattr(simhash, "plan_groups", lambda *_: fixed)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print bigint")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table, 2, bucket_rows).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)

    def classes(pairs):
        label = {p: p for p in prints}
        for _ in prints:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    brute = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 2]
    assert classes(links) == classes(brute)


def test_sorting_by_masks_connects_like_comparing_pairs(monkeypatch):
    rng = random.Random(8)
    prints = {0, 1, 3, 7, 15}
    for p in [rng.getrandbits(64) for _ in range(20)]:
        prints |= {p, p ^ 1, p ^ 6, p ^ 7 << 40}
    prints = np.array(sorted(prints), np.uint64)

    def classes(pairs):
        label = list(range(len(prints)))
        for _ in range(8):
            for a, b in pairs.tolist():
                label[a] = label[b] = min(label[a], label[b])
        return label

    pairwise = simhash.spanning_links(prints, 2)
    monkeypatch.setattr(simhash, "_PAIRWISE_ROWS", 1)
    assert classes(simhash.spanning_links(prints, 2)) == classes(pairwise)


def test_allocation_sums_to_the_pigeonhole_bound():
    for groups in (1, 2, 3):
        _, chosen = simhash.allocate([5.0] * groups, [64 // groups] * groups, 10**9, 2)
        assert sum(chosen) == 2 - groups + 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 201), (5, 5)], "a bigint, b bigint")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(71)} | {200: 200, 201: 200}
    assert components.components(links.limit(0)).count() == 0


def test_near_copies_empty(empty):
    assert simhash.drop_near_copies(empty).count() == 0


# --- 9 language ---------------------------------------------------------------------


def test_language_accuracy(spark, tmp_path):
    stock = {"en": "the of and that with house garden", "de": "der die und nicht schön straße über", "fr": "le que été dans où être ça"}
    rng, rows = random.Random(2), []
    for i in range(400):
        lang = rng.choice(list(stock))
        rows.append((i, " ".join(rng.choices(stock[lang].split(), k=rng.randint(5, 60))), lang))
    rows += [(1000, None, "en"), (1001, "12 34 !", "de"), (1002, "", "fr"), (1003, "house " * 300_000, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).write.parquet(str(tmp_path / "d"))
    found = {r.doc_id: r for r in lang_id.identify(spark.read.parquet(str(tmp_path / "d")), rows_per_language=60).collect()}
    held = [r for r in rows if found[r[0]].held_out and r[0] < 1000]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in found)
    assert sum(found[i].lang_pred == lang for i, _, lang in held) > 0.97 * len(held)
    assert all((found[i].lang_pred, found[i].score) == ("und", 0) for i in (1000, 1001, 1002))
    assert found[1003].lang_pred == "en" and all(0 <= r.score <= 1 for r in found.values())


def test_language_without_labels(docs, empty):
    nothing = lang_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert lang_id.identify(empty).count() == 0


def test_grams_do_not_cross_texts():
    joined, first, _ = lang_id.gram_columns(["ab c", "", "de"])
    for i, text in enumerate(["ab c", "", "de"]):
        alone, _, _ = lang_id.gram_columns([text])
        end = [*first[1:], len(joined[0])][i]
        for n in range(3):
            mine = joined[n][first[i] : end]
            assert sorted(mine[mine < lang_id._DUMMY]) == sorted(alone[n][alone[n] < lang_id._DUMMY])


# --- 10 packing ---------------------------------------------------------------------


def best_fit(histogram, capacity):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            open_rooms = [(room, i) for i, room in enumerate(rooms) if room >= length]
            if open_rooms:
                rooms[min(open_rooms)[1]] -= length
            else:
                rooms.append(capacity - length)
    return sorted(rooms)


def test_steps_are_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(100):
        capacity = rng.choice([7, 16, 50])
        histogram = {rng.randint(1, capacity): rng.randint(1, 20) for _ in range(rng.randint(1, 12))}
        steps, bins = packing.best_fit_steps(histogram, capacity), {}
        for length, count in histogram.items():
            mine = sorted(s for s in steps if s[0] == length)
            for number in range(count):
                _, first, bin_, per_bin, offset = mine[bisect.bisect([s[1] for s in mine], number) - 1]
                turn = number - first
                bins.setdefault(bin_ + turn // per_bin, []).append((offset + turn % per_bin * length, length))
        for held in bins.values():
            held.sort()
            assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sorted(capacity - sum(n for _, n in held) for held in bins.values()) == best_fit(histogram, capacity)


@pytest.mark.parametrize("cached", [3, 250_000])
def test_packing(docs, rows, empty, monkeypatch, cached):
    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    encoder = packing.WordEncoder(WORD_VOCABULARY)
    want = Counter()
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode((t or "").encode()), "<u4").tolist() == ids
        ids.append(1)
        for piece, at in enumerate(range(0, len(ids), 64)):
            some = ids[at : at + 64]
            want[(i, piece, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes()))] += 1
    found = packing.pack(docs, WORD_VOCABULARY, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
    histogram = Counter(r.length for r in found)
    assert sorted(64 - sum(n for _, n in held) for held in bins.values()) == best_fit(histogram, 64)
    assert packing.pack(empty, WORD_VOCABULARY).count() == 0


CONTROLS = [
    "a <|EndOfText|> b",
    "a <|endoftext|> b",
    "A<|ENDOFTEXT|>B <|startoftext|>C, Word",
    "<|endoftext|><|EndOfText|>. <|StartOfText|>",
    "<|End OfText|> <|endoftext|",
]


def test_control_strings_keep_their_case(spark, tmp_path):
    tokenizer, encoder = Tokenizer.from_file(WORD_VOCABULARY), packing.WordEncoder(WORD_VOCABULARY)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in CONTROLS]
    assert [np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() for t in CONTROLS] == want
    spark.createDataFrame([*enumerate(CONTROLS)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    found = {r.doc_id: r for r in packing.pack(spark.read.parquet(f"{tmp_path}/docs"), WORD_VOCABULARY, with_ids=True).collect()}
    for i, ids in enumerate(want):
        some = np.array([*ids, packing.END_ID], "<u4").tobytes()
        assert (found[i].length, found[i].ids, found[i].ids_crc32) == (len(ids) + 1, some, zlib.crc32(some))


def test_word_merges_equal_the_tokenizer():
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    merges = word_bpe.merges_like(WORD_VOCABULARY, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    rng = random.Random(6)
    for _ in range(3000):
        word = "".join(rng.choices("etaoinshrdlucmfwypvbgkjqxzéüñßèêçÉ", k=rng.randint(1, 14)))
        assert merges.encode(word_bpe.plain(word.encode())) == tokenizer.encode(word, add_special_tokens=False).ids
    assert word_bpe.plain("İ".encode()) is None and word_bpe.plain(b"a1") is None
