"""Token ids of whole words by the merges of a BPE vocabulary with word ends.

The tokenizer library normalises, splits and builds several objects for every word it is given;
for plain lower-case words all of that changes nothing, and only the merges are left to do.
These are run by tiktoken on the word's bytes with a closing byte that no UTF-8 text holds: it
is merged into the last byte first, which gives the vocabulary's word-end units. The result is
compared with the tokenizer's on a few thousand words before it is used at all.
"""

import json

import tiktoken

_CLOSE = b"\xff"
_PROBES = 4000


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class WordMerges:
    """``encode(word)`` for UTF-8 words for which ``is_plain`` holds."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix, byte_of = model["end_of_word_suffix"], byte_alphabet()

        def raw(token):
            stem = token.removesuffix(suffix)
            return bytes(byte_of[c] for c in stem) + (_CLOSE if stem != token else b"")

        vocabulary = {raw(token): number for token, number in model["vocab"].items()}
        units = [t for t in vocabulary if len(t) == 1]
        closed = [t for t in vocabulary if len(t) == 2 and t.endswith(_CLOSE)]
        merged = [raw(left) + raw(right) for left, right in model["merges"]]
        order = dict.fromkeys([*units, _CLOSE, *closed, *merged])
        ranks = {token: rank for rank, token in enumerate(order)}
        self._number = [vocabulary.get(token, -1) for token in ranks]
        self._pieces = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def encode(self, word: bytes) -> list[int]:
        return [self._number[i] for i in self._pieces(word + _CLOSE)]


def plain(word: bytes) -> bytes | None:
    """The word in lower case if it is only Latin letters, which no normalisation changes."""
    if word.isalpha():  # bytes: ASCII letters
        return word.lower()
    text = word.decode()
    if text.isalpha() and max(text) < "ƀ" and "İ" not in text:
        return text.lower().encode()
    return None


def merges_like(path: str, encode) -> WordMerges | None:
    """The merges of a tokenizer file, if they give what ``encode`` gives for plain words."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model.get("type", "BPE") != "BPE" or not model.get("end_of_word_suffix"):
        return None
    merges = WordMerges(path)
    suffix = model["end_of_word_suffix"]
    stems = [t.removesuffix(suffix) for t in model["vocab"] if t.removesuffix(suffix).isascii() and t.removesuffix(suffix).isalpha()]
    step = max(1, 2 * len(stems) // _PROBES)
    probes = stems[::step] + [a + b for a, b in zip(stems[::step], stems[step // 2 :: step])]
    same = all(merges.encode(p.lower().encode()) == encode(p) for p in probes)
    return merges if same else None
