"""Token ids by the tokenizers library, with repeated parts of texts encoded once per worker.

A byte-level BPE splits a text into pre-tokens and encodes each on its own, so a text may be cut at any bound of
pre-tokens and its parts encoded separately.  Bounds that two neighbouring characters prove are: white space after
anything else; a letter before a sign, digit or blank; a sign other than the apostrophe, or a digit, before a letter.
They are used where both characters are ASCII, or the first is a letter of Latin-1; around other characters a
text is not cut but before ASCII white space, and not next to control signs that may count as white space.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from leafpress.llm.interning import Spans, WordTable, remembered, text_bytes

_SIGN, _LETTER, _WHITE, _WIDE, _UNSURE, _QUOTE = range(6)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _WHITE
_CLASS[0x80:] = _WIDE
_CLASS[[0x00, *range(0x1C, 0x20)]] = _UNSURE
_CLASS[0x27] = _QUOTE
#: Whether a pair of classes, 8 * first + second, is a bound; 2: if the first is a letter of Latin-1; 3: if it is not white space.
_BOUND = np.zeros(64, np.uint8)
for _first in (_SIGN, _LETTER, _QUOTE):
    _BOUND[8 * _first + _WHITE] = 1
for _second in (_SIGN, _QUOTE):
    _BOUND[8 * _LETTER + _second] = 1
    _BOUND[8 * _WIDE + _second] = 2
_BOUND[8 * _SIGN + _LETTER] = 1
_BOUND[8 * _WIDE + _WHITE] = 3
_LATIN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    return remembered(("tokens", path), lambda: WordEncoder(path))


def _latin_letter(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the two bytes before each place are a letter from U+00C0 to U+00FF."""
    last = data[at - 1]
    return (data[at - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)


def _wide_blank(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bytes before each place may be white space (U+0085, 00A0, 1680, 180E, 2000-200F, 2028-202F, 205F-2060, 3000, FEFF)."""
    c, b, a = data[at - 1], data[at - 2], data[at - 3]
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8F) | ((c >= 0xA8) & (c <= 0xAF)))) | ((b == 0x81) & ((c == 0x9F) | (c == 0xA0))))
    others = ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xEF) & (b == 0xBB) & (c == 0xBF))
    return two | general | others


def parts_of(column: pa.Array) -> Spans:
    """Cuts every text into parts that may be encoded apart; they cover it."""
    data, bounds = text_bytes(column)
    n = int(bounds[-1])
    kind = _CLASS[data[:n]]
    rule = np.zeros(n, np.uint8)
    rule[1:] = _BOUND[(kind[:-1] << 3) | kind[1:]]
    for which, check in ((2, _latin_letter), (3, lambda d, a: ~_wide_blank(d, a))):
        at = np.flatnonzero(rule == which)
        rule[at] = (at >= 3) & check(data, np.maximum(at, 3))
    rule[bounds[:-1][bounds[:-1] < n]] = 1
    starts = np.flatnonzero(rule)
    return Spans(data, starts, np.diff(np.append(starts, n)), np.diff(np.searchsorted(starts, bounds)))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: How the pre-tokenizer writes a blank, and each byte of the letters from U+00C0 to U+00FF.
        signs = lambda c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))
        self.blank = signs(" ")
        self.signs = {b: s for c in map(chr, range(0xC0, 0x100)) for b, s in zip(c.encode(), signs(c), strict=True)}
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = WordTable(self._learn)
        self.pool = np.empty(0, np.uint32)
        self.used, self.mark = 0, (0, 0)

    def _ids(self, part: bytes) -> list[int]:
        text = part.decode()
        word = text[1:] if text[0] == " " else text
        if word.isalpha() and (word.isascii() or _LATIN.fullmatch(word)):  # one pre-token
            signs = word if word.isascii() else word.encode().decode("latin-1").translate(self.signs)
            return [t.id for t in self.model.tokenize(signs if word is text else self.blank + signs)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What was learnt last is overwritten if it was not remembered."""
        known = self.words.size
        self.mark = (known, self.used) if known != self.mark[0] else self.mark
        self.used = self.mark[1]
        ids = list(map(self._ids, parts))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        end = self.used + int(sizes.sum())
        if end > len(self.pool):
            grown = np.empty(2 * end, np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : end] = np.fromiter(chain.from_iterable(ids), np.uint32, end - self.used)
        starts = self.used + np.cumsum(sizes) - sizes
        self.used = end
        return starts, sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one row, and how many each text has.  A null text is an empty one."""
        spans = parts_of(column)
        counts, ids = np.zeros(len(column), np.int64), np.empty(0, np.uint32)
        if len(spans.starts):
            rows = self.words.rows(spans)
            starts, sizes = self.words.fields[0][rows], self.words.fields[1][rows]
            ends = np.cumsum(sizes)
            ids = self.pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
            counts = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(spans.counts)])])
        raw = spans.data.tobytes()
        if any(s in raw for s in self.special):  # texts with special tokens are encoded whole
            pieces, at = np.split(ids, np.cumsum(counts)[:-1]), column.to_pylist()
            for k, text in enumerate(at):
                if text and any(s in text.encode() for s in self.special):
                    pieces[k] = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            ids, counts = np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        return ids, counts

    def encode_with_end(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text."""
        ids, counts = self.encode(column)
        out = np.full(len(ids) + len(counts), end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts + 1) - 1] = False
        out[inner] = ids
        return out, counts + 1
