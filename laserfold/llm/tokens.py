"""Token ids of whole texts, as a tokenizer file of the `tokenizers` library gives them.

White space parts tokens in a word-end vocabulary. Texts of Latin letters are split
into pre-tokens here, by the file's pattern, and each distinct pre-token goes through
the library's merge model once per worker. Whatever else a text holds (other scripts,
letters that are not composed, special strings) goes, between white space, through the
library's whole chain. Files whose tokens may span white space are encoded text by text.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np

# White space in the sense of Unicode, as the tokenizer file's pattern uses it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BETWEEN = re.compile(f"[^{SPACES}]+")
LAST_LATIN = "\u024f"
BEYOND_LATIN = re.compile(f"[^\\x00-{LAST_LATIN}]")
# Words that are kept for reuse; beyond, a worker's table starts anew (only speed changes).
KEPT_WORDS = 300_000
KEPT_LENGTH = 48


def latin(kind: str) -> str:
    """Characters of a Unicode category up to the last Latin letter, for a pattern's class."""
    every = map(chr, range(ord(LAST_LATIN) + 1))
    return "".join(re.escape(c) for c in every if unicodedata.category(c).startswith(kind))


# The pre-tokens of the word-end file: contractions, letters, single digits, other marks.
# Letters are tried first, as most pre-tokens are words; only an apostrophe can start two
# kinds, and there contractions come before marks.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed values of the file
LATIN_WORDS = re.compile(
    f"[{latin('L')}]+|{CONTRACTIONS}|[{latin('N')}]|[^{SPACES}{latin('L')}{latin('N')}]+"
)
# The same for texts of ASCII in lower case.
ASCII_WORDS = re.compile(f"[a-z]+|{CONTRACTIONS}|[0-9]|[^{SPACES}a-z0-9]+")


def words(lowered: str) -> list[str]:
    """The pre-tokens of a text that `_plain` gave."""
    return (ASCII_WORDS if lowered.isascii() else LATIN_WORDS).findall(lowered)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Kept(dict):
    """word -> value, filled on demand and emptied when it is full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


def _plain(text: str) -> str | None:
    """The text in lower case if the Latin pattern splits it as the file does, else None."""
    if "<|" in text:
        return None
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        return None
    lowered = text.lower()
    if BEYOND_LATIN.search(text) or BEYOND_LATIN.search(lowered):
        return None
    return lowered


class Encoder:
    """Ids or counts for texts under one tokenizer file."""

    def __init__(self, path: str, whole: frozenset[str] = frozenset()):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.by_word = (described.get("model") or {}).get("end_of_word_suffix") == "</w>"
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self._tokenize = self.tokenizer.model.tokenize
        self.word_ids = _Kept(lambda word: array("I", self._merge(word)).tobytes())
        self.word_counts = _Kept(lambda word: 1 if word in whole else len(self._merge(word)))

    def _merge(self, word: str) -> list[int]:
        if not word.isascii() or not word.isprintable():
            word = word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self._tokenize(word)]

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        """All ids of the text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return np.array(self._library(text), "<u4").tobytes()
        lowered = _plain(text)
        if lowered is not None:
            return b"".join(map(self.word_ids.__getitem__, words(lowered)))
        parts = []
        for piece in BETWEEN.findall(text):
            lowered = _plain(piece)
            if lowered is None:
                parts.append(np.array(self._library(piece), "<u4").tobytes())
            else:
                parts.extend(map(self.word_ids.__getitem__, words(lowered)))
        return b"".join(parts)

    def count(self, text: str) -> int:
        if not self.by_word:
            return len(self._library(text))
        lowered = _plain(text)
        if lowered is not None:
            return sum(map(self.word_counts.__getitem__, words(lowered)))
        total = 0
        for piece in BETWEEN.findall(text):
            lowered = _plain(piece)
            if lowered is None:
                total += len(self._library(piece))
            else:
                total += sum(map(self.word_counts.__getitem__, words(lowered)))
        return total

    def counts(self, texts: Iterable[str]) -> list[int]:
        return [self.count(t) for t in texts]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it lives as long as the Python worker."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def alignment_paths() -> tuple[str, str]:
    """A byte-level vocabulary and one of pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
