"""Registered queries on hostile tables, against plain versions of what they promise."""

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from tokenizers import Tokenizer

from starmart.llm import alignment, merkle, token_files
from starmart.llm.queries import QUERIES
from starmart.llm.word_bpe import byte_alphabet
from tests.llm import hostile


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return hostile.write(spark, str(tmp_path_factory.mktemp("hostile")), hostile.documents())


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    return hostile.write(spark, str(tmp_path_factory.mktemp("empty")), [], files=1)


@pytest.fixture(scope="module")
def docs():
    names = [c.split()[0] for c in hostile.SCHEMA.split(", ")]
    rows = [dict(zip(names, r)) for r in hostile.documents()]
    return sorted(rows, key=lambda d: (d["doc_id"], d["text"] or ""))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def rows_of(spark, name, folder, *columns):
    found = QUERIES[name](spark, folder).select(*columns).collect()
    return sorted((tuple(r) for r in found), key=str)


def agrees(spark, name, folder, columns, expected):
    assert rows_of(spark, name, folder, *columns.split()) == sorted(expected, key=str)


NEW = ["op11_cross_tokenizer_alignment", "op12_token_files", "op13_merkle_manifest"]


@pytest.mark.parametrize("name", [*NEW, "op6_byte_bpe", "op7_suffix_dedup", "op8_simhash", "op10_packing"])
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


# --- byte-level BPE, repeats, fingerprints, packing ------------------------------------


def test_byte_bpe(spark, folder, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for d in docs:
        ids = encoding.encode_ordinary(d["text"] or "")
        expected.append((d["doc_id"], len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((d["text"] or "").encode())))
    agrees(spark, "op6_byte_bpe", folder, "doc_id n_tokens ids_sha256 decoded_sha256", expected)


def test_repeats(spark, folder, docs):
    seen, expected = set(), []
    for d in docs:
        text, gone = (d["text"] or "").encode(), np.zeros(len((d["text"] or "").encode()) + 1, bool)
        for i in range(len(text) - 99):
            window = text[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if text else 0
        expected.append((d["doc_id"], len(text), len(text) - len(kept), spans, sha(kept)))
    agrees(spark, "op7_suffix_dedup", folder, "doc_id n_bytes n_removed n_spans kept_sha256", expected)


def fingerprint(text) -> int:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lowered).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, folder, docs):
    prints = {}
    for d in docs:
        prints.setdefault(fingerprint(d["text"]), []).append(d["doc_id"])
    values = list(prints)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = defaultdict(lambda: 1 << 62)
    for i, v in enumerate(values):
        least[root(i)] = min(least[root(i)], *prints[v], 1 << 62)
    expected = [(doc, f"{v:016x}", least[root(i)]) for i, v in enumerate(values) for doc in prints[v]]
    agrees(spark, "op8_simhash", folder, "doc_id fingerprint component_id", expected)


@pytest.fixture(scope="module")
def word_ids(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4") for d in docs]


def best_fit(lengths: list[int], capacity: int) -> int:
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_packing(spark, folder, docs, word_ids):
    found = rows_of(spark, "op10_packing", folder, "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    pieces = [
        (d["doc_id"], at // 4096, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()))
        for d, ids in zip(docs, word_ids)
        for at in range(0, len(ids), 4096)
    ]
    assert sorted(r[:5] for r in found) == sorted(pieces)
    sequences = defaultdict(list)
    for r in found:
        sequences[r[5]].append((r[6], r[3]))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) == best_fit([p[3] for p in pieces], 4096)


# --- alignment ------------------------------------------------------------------------


def plain_alignment(docs):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of, found, documents = byte_alphabet(), [], Counter()

    def grouped(ids, raws, cuts):
        out, at = [[]], 0
        for i, raw in zip(ids, raws):
            out[-1].append(i)
            at += len(raw)
            if at in cuts:
                out.append([])
        return out[:-1]

    for d in docs:
        text = d["text"]
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_raw = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        b_raw = [bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
            found.append((d["doc_id"], None))
            continue
        ends = [set(np.cumsum([len(r) for r in raws]).tolist()) for raws in (a_raw, b_raw)]
        cuts = ends[0] & ends[1]
        groups = list(zip(grouped(a, a_raw, cuts), grouped(b, b_raw, cuts)))
        links = Counter((x, y) for some, others in groups for x in some for y in others)
        documents.update(links.keys())
        found.append((d["doc_id"], (len(a), len(b), groups, links)))
    highest = defaultdict(int)
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    rows = []
    for doc, result in found:
        if result is None:
            rows.append((doc, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, groups, links = result
        n_best = sum(n for pair, n in links.items() if documents[pair] == highest[pair[0]])
        total = sum(n * documents[pair] for pair, n in links.items())
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc, n_a, n_b, len(groups), sum(links.values()), n_best, total, sha(text.encode()), text))
    return rows, documents, highest


COUNTS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"


def test_alignment(spark, folder, docs):
    expected, _, _ = plain_alignment(docs)
    assert sum(r[1] == 0 for r in expected) == 4 and max(r[3] for r in expected) > 10_000
    agrees(spark, "op11_cross_tokenizer_alignment", folder, COUNTS, [r[:-1] for r in expected])


@pytest.mark.parametrize("batch_bytes,chunk_bytes", [(1, 1), (200, 3000), (1 << 20, 4000)])
def test_alignment_in_small_chunks(spark, folder, docs, batch_bytes, chunk_bytes, monkeypatch):
    monkeypatch.setattr(alignment, "_BLOCK", 50)
    some = [d for d in docs if len(d["text"] or "") < 3000]
    table = spark.read.parquet(f"{folder}/documents.parquet").filter("text is null or length(text) < 3000")
    vocabularies = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    made = alignment.align(table, *vocabularies, public_tokenizers.PATTERN, batch_bytes=batch_bytes, chunk_bytes=chunk_bytes, with_groups=True)
    expected, documents, highest = plain_alignment(some)
    assert sorted(map(tuple, made.documents.collect()), key=str) == sorted(expected, key=str)
    pairs = {(r.a, r.b): (r.documents, r.is_best) for r in made.pairs.collect()}
    assert pairs == {p: (n, n == highest[p[0]]) for p, n in documents.items()}


def test_pairs_in_small_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    n_groups, doc = 40, np.sort(rng.integers(0, 5, 40))
    a_group, b_group = (np.sort(np.concatenate([np.arange(n_groups), rng.integers(0, n_groups, 200)])) for _ in range(2))
    a, b = rng.integers(0, 9, len(a_group)), rng.integers(0, 9, len(b_group))
    expected = Counter(
        (int(doc[g]) << 42 | int(x) << 21 | int(y)) for g in range(n_groups) for x in a[a_group == g] for y in b[b_group == g]
    )
    for block in (1, 7, 1 << 22):
        monkeypatch.setattr(alignment, "_BLOCK", block)
        keys, links = alignment._pairs(doc, a_group, a, b_group, b)
        assert dict(zip(keys.tolist(), links.tolist())) == expected and (np.diff(keys) > 0).all()


def test_byte_level_equals_the_tokenizer_library():
    """Pre-tokens by every character, and random texts."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), alignment.ByteLevel(path, public_tokenizers.PATTERN)
    library.encode_special_tokens = True
    rng = random.Random(1)
    texts = [f"a{c}b 1{c}2 {c}{c} !{c}? \n{c}  {c}\t" for c in map(chr, [*range(0, 0x3200), *range(0xFE00, 0x10000), 0x1F600, 0x10FFFF])]
    texts += ["".join(rng.choices(" \n\t'sdABé日0.1!<|>　\u0085", k=200)) for _ in range(300)] + ["<|endoftext|>a"]
    assert own.encode(texts) == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]


# --- token files ----------------------------------------------------------------------


def test_token_files(spark, folder, docs, word_ids):
    found = rows_of(spark, "op12_token_files", folder, "doc_id", "start", "n_tokens", "ids_crc32")
    by_id = defaultdict(list)
    for d, ids in zip(docs, word_ids):
        by_id[d["doc_id"]].append((len(ids), zlib.crc32(ids.tobytes())))
    # rows of one id may follow each other in any order that depends on their texts only
    assert Counter((r[0], *r[2:]) for r in found) == Counter((doc, *x) for doc, some in by_id.items() for x in some)
    at = 0
    for doc, start, length, _ in sorted(found):
        assert start == at, doc
        at += length


@pytest.mark.parametrize("file_tokens", [1, 700, 1 << 23])
def test_any_token_is_found_by_its_place(spark, folder, docs, file_tokens):
    some = [d for d in docs if len(d["text"] or "") < 3000]
    table = spark.read.parquet(f"{folder}/documents.parquet").filter("text is null or length(text) < 3000")
    index = token_files.write_tokens(table, public_tokenizers.path("word_bpe_49k.json"), file_tokens=file_tokens)
    rows = sorted(token_files.read_tokens(index).collect(), key=lambda r: r.start)
    assert len(rows) == len(some) and all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    flat = np.frombuffer(b"".join(r.ids for r in rows), "<u4")
    assert [r.start for r in rows] == (np.cumsum([r.n_tokens for r in rows]) - [r.n_tokens for r in rows]).tolist()
    places = [0, len(flat) - 1, *random.Random(2).choices(range(len(flat)), k=200)]
    asked = spark.createDataFrame([(p,) for p in [*places, -1, len(flat)]], "position bigint")
    for width in (100, 1 << 23):
        got = token_files.tokens_at(index, asked, width).collect()
        assert sorted((r.position, r.id) for r in got) == sorted((p, int(flat[p])) for p in places)


@pytest.mark.parametrize("most", [1, 2, 300, 1 << 16, 1 << 32])
@pytest.mark.parametrize("count", [0, 1, 511, 512, 513, 5000])
def test_codes_give_every_run_back(tmp_path, most, count):
    rng = np.random.default_rng(count)
    ids = (most * rng.random(count) ** 3).astype("<u4")
    path = f"{tmp_path}/x.tok"
    token_files.write_file(path, [5, None], [count, 0], ids)
    with token_files.TokenFile(path) as file:
        assert file.tokens == count and file.documents == 2
        assert file.ids(0, count).tolist() == ids.tolist()
        for a, b in rng.integers(0, count + 1, (30, 2)):
            a, b = sorted((int(a), int(b)))
            assert file.ids(a, b).tolist() == ids[a:b].tolist()
        for level in range(len(file.widths) - 1):
            flags = file._flags(level, 0, file_count := sum(ids >> sum(file.widths[:level]) > 0) if level else count)
            for place in {0, 1, 511, 512, 513, file_count} & set(range(file_count + 1)):
                assert file.rank(level, place) == int(flags[:place].sum())
        with pytest.raises(IndexError):
            file.id_at(count)


def test_widths_are_the_best():
    """Against all ways to cut up to nine bits."""
    rng = np.random.default_rng(4)

    def cuts(bits):
        yield [bits]
        for first in range(1, bits):
            for rest in cuts(bits - first):
                yield [first, *rest]

    def cost(widths, counts):
        bits, done = 0.0, 0
        for i, width in enumerate(widths):
            here = counts[done + 1 :].sum() if done else counts.sum()
            bits += here * (width + (0 if i == len(widths) - 1 else 1 + 32 / token_files.RANK_BITS))
            done += width
        return bits

    for _ in range(20):
        counts = np.zeros(33, np.int64)
        counts[: rng.integers(2, 10)] = rng.integers(0, 1000, 10)[: rng.integers(2, 10)].sum() % 977
        counts[rng.integers(0, 9)] += rng.integers(1, 5000)
        most = max(1, int(np.flatnonzero(counts).max()))
        best = token_files.best_widths(counts)
        assert sum(best) == most
        assert cost(best, counts) == pytest.approx(min(cost(w, counts) for w in cuts(most)))


def test_a_file_cut_short_is_refused(tmp_path):
    path = tmp_path / "x.tok"
    token_files.write_file(str(path), [1], [3], np.array([1, 2, 70000], "<u4"))
    path.write_bytes(path.read_bytes()[:-1])
    with pytest.raises(ValueError):
        token_files.TokenFile(str(path))


# --- manifest -------------------------------------------------------------------------


def plain_leaf(d, lower=False) -> str:
    out = b""
    for name in merkle.COLUMNS:
        if d[name] is None:
            out += b"-"
            continue
        value = str(d[name]).encode()
        if lower and name == "text":
            value = bytes(b + 32 if 65 <= b <= 90 else b for b in value)
        out += str(len(value)).encode() + b":" + value
    return sha(out)


def plain_tree(leaves: list[str], fanout: int):
    """(root, per leaf the (left, right) siblings of each level)"""
    steps, groups, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        above, joined = [], []
        for at in range(0, len(level), fanout):
            run = level[at : at + fanout]
            for k in range(len(run)):
                for leaf in groups[at + k]:
                    steps[leaf].append((run[:k], run[k + 1 :]))
            above.append(sha("".join(run).encode()))
            joined.append(sum(groups[at : at + fanout], []))
        level, groups = above, joined
    return level[0], steps


def plain_manifest(docs, fanout=16):
    by_source = defaultdict(list)
    for d in docs:
        by_source[d["source"]].append(d)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        some = sorted(by_source[source], key=lambda d: (d["doc_id"] is not None, d["doc_id"], plain_leaf(d)))
        trees.append((some, *plain_tree([plain_leaf(d) for d in some], fanout)))
    root, top = plain_tree([t[1] for t in trees], fanout)
    for (some, subroot, steps), last in zip(trees, top):
        for d, first in zip(some, steps):
            path = first + last
            tampered = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0
            folded = plain_leaf(d, tampered)
            for left, right in path:
                folded = sha("".join([*left, folded, *right]).encode())
            proof = sha("".join("".join(left + right) for left, right in path).encode())
            yield d["doc_id"], plain_leaf(d), subroot, root, proof, folded, folded == root


MANIFEST = "doc_id leaf subroot root proof_sha256 folded_root verified"


def test_manifest(spark, folder, docs):
    expected = list(plain_manifest(docs))
    assert {r[-1] for r in expected} == {True, False}
    agrees(spark, "op13_merkle_manifest", folder, MANIFEST, expected)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2], [4, 5, 1, 17, 1, 1, 64, 65], [1] * 20, [3] * 9 + [100]])
def test_trees_of_any_shape(spark, tmp_path, sizes):
    rows = [(i, f"Text {i}", None, f"s{j:02}", None, *hostile._OTHERS) for j, n in enumerate(sizes) for i in range(100 * j, 100 * j + n)]
    hostile.write(spark, str(tmp_path), rows)
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    made = merkle.manifest(table, fanout=4)
    names = [c.split()[0] for c in hostile.SCHEMA.split(", ")]
    expected = {r[0]: r for r in plain_manifest([dict(zip(names, r)) for r in rows], 4)}
    found = made.rows.select("doc_id", "leaf", "subroot", merkle.proof().alias("proof"), merkle.fold("leaf").alias("folded")).collect()
    assert len(found) == len(expected)
    for r in found:
        assert (r.leaf, r.subroot, made.root, sha(r.proof.encode()), r.folded) == (*expected[r.doc_id][1:5], made.root)
    inside = made.nodes.filter("tree = 'source'").collect()
    assert all(r.hi - r.lo <= 4**r.level for r in inside) and sum(r.level == 0 for r in inside) == sum(sizes)


def test_manifest_without_ids(spark, tmp_path):
    rows = [(None, None, None, None, None, *hostile._OTHERS)] * 40 + [(None, "t", "en", "s", 1, *hostile._OTHERS)]
    hostile.write(spark, str(tmp_path), rows)
    names = [c.split()[0] for c in hostile.SCHEMA.split(", ")]
    agrees(spark, "op13_merkle_manifest", str(tmp_path), MANIFEST, list(plain_manifest([dict(zip(names, r)) for r in rows])))
