"""Quality rules on repetition: characters inside duplicated word n-grams and duplicated lines."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.llm.interning import text_chunks, words_of

#: n-gram lengths, and the share of word characters that duplicated ones of that length may cover (fixed values of
#: published web-corpus rules); then the share of characters in duplicated lines.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 50, 3, 50
_SYMBOLS = b"#*$%&|<>"
_OTHERS = bytes(sorted(set(range(256)) - set(_SYMBOLS)))
_TAILS = bytes(range(0x80, 0xC0))
_BLANK = re.compile(rb"[\x20\x09-\x0D]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_share double, " + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_LIMITS)


def code_points(text: bytes) -> int:
    return len(text.translate(None, _TAILS))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each window of ``n`` words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * _MUL + hashes[k : len(hashes) - n + 1 + k]
    return out ^ (out >> np.uint64(32))


def duplicated(keys: np.ndarray) -> np.ndarray:
    """Marks keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(marks: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside marked windows of ``n``."""
    edges = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(marks)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: bytes, hashes: np.ndarray, chars: np.ndarray) -> tuple:
    """The readings of one text, in the order of ``SCHEMA``."""
    n, total = len(hashes), int(chars.sum())
    lines = [x for x in text.split(b"\n") if x and not _BLANK.fullmatch(x)]
    seen: set[bytes] = set()
    repeated = line_chars = 0
    if len(set(lines)) < len(lines):
        for line in lines:
            if line in seen:
                repeated += 1
                line_chars += code_points(line)
            seen.add(line)
    share = line_chars / max(1, sum(map(code_points, lines))) if repeated else 0.0
    shares, repeat_words, least = [0.0] * len(NGRAM_LIMITS), 0, np.empty(0, bool)
    if n > REPEAT_WINDOW:
        marks = duplicated(rolling(hashes, REPEAT_WINDOW))
        if marks.any():
            repeat_words = int(covered(marks, REPEAT_WINDOW, n).sum())
            least = marks
    if least.any():  # a duplicated longer n-gram starts with a duplicated window of three words
        for k, size in enumerate(NGRAM_LIMITS):
            at = np.flatnonzero(least[: max(0, n - size + 1)])
            if len(at) < 2:
                break
            keys = rolling(hashes, size)[at]
            marks = np.zeros(n - size + 1, bool)
            marks[at[duplicated(keys)]] = True
            if not marks.any():
                break
            shares[k] = float(chars[covered(marks, size, n)].sum() / total)
    return (n, total, len(text.translate(None, _OTHERS)), repeated, repeat_words, share, *shares)


def repetition_readings(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id`` and the columns of ``SCHEMA``, over the whole text.

    Words are runs of characters other than ASCII white space, compared as written.  Null or empty text: zeros.
    Null and repeated ids pass through; other columns are ignored; an empty table gives no rows.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
        types = [pa.int64() if x.endswith(" long") else pa.float64() for x in SCHEMA.split(", ")]
        for batch in batches:
            for chunk in text_chunks(batch):
                texts = [t or b"" for t in chunk.column("text").cast(pa.binary()).to_pylist()]
                words = words_of(chunk.column("text"))
                hashes = words.hashes()
                points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
                chars = points[words.starts + words.sizes] - points[words.starts]
                ends = np.cumsum(words.counts)
                found = [measure(t, hashes[a:e], chars[a:e]) for t, a, e in zip(texts, (ends - words.counts).tolist(), ends.tolist(), strict=True)]
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", *names])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(read, f"doc_id long, {SCHEMA}")


def quality_rules(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The readings with ``base_failed`` and ``kept``.

    Base: fewer than 50 words, or over half of the words in repeated three-word windows.  Kept: not failed, and no
    n-gram length covers more characters, nor duplicated lines more, than its limit.
    """
    base = F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")
    within = F.expr(" and ".join([f"dup_line_share <= {LINE_LIMIT}D", *(f"dup_{n}gram_share <= {x}D" for n, x in NGRAM_LIMITS.items())]))
    return repetition_readings(df, text_col, id_col).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & within)
