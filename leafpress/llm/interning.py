"""Words of many texts at once: numpy finds them in the bytes of an Arrow column, and a bounded memory per worker holds
what was computed for a word, so that a repeated word costs one look-up in an array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that one worker remembers; further ones are learnt each time anew.  Bounds memory, never results.
WORD_LIMIT = 1_000_000
#: Words of up to so many bytes are told apart by two integers; longer ones by a dictionary of bytes.
SHORT = 15
#: Longer words are never remembered, nor are words of over ``SHORT`` bytes once they take so many bytes together.
LONGEST_WORD, LONG_BYTES = 200, 24_000_000
#: Bytes of text that are turned into words at once.
CHUNK_BYTES = 2_000_000

_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ONE, _BITS = np.uint64(1), np.uint64(63)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Spans:
    """Runs of bytes in the texts of a chunk, in order."""

    data: np.ndarray  # all texts side by side, with spare bytes behind
    starts: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray  # runs of each text

    def of_text(self) -> np.ndarray:
        """The number of the text that each run belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def loads(self) -> tuple[np.ndarray, np.ndarray]:
        """The first 8 and the next 8 bytes of each run, zero behind its end."""
        longs = self.data.view("<u8")
        at, shift = self.starts >> 3, (self.starts & 7).astype(np.uint64) << np.uint64(3)
        back = _BITS - shift
        a, b, c = longs[at], longs[at + 1], longs[at + 2]
        low = (a >> shift) | ((b << _ONE) << back)
        high = (b >> shift) | ((c << _ONE) << back)
        return low & _LOW[np.minimum(self.sizes, 8)], high & _LOW[np.clip(self.sizes - 8, 0, 8)]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each run's bytes."""
        low, high = self.loads()
        out = mix(mix(low + self.sizes.astype(np.uint64)) ^ high)
        left, k = np.flatnonzero(self.sizes > 16), 16
        while len(left):
            part = Spans(self.data, self.starts[left] + k, self.sizes[left] - k, self.counts)
            low, high = part.loads()
            out[left] = mix(mix(low + out[left]) ^ high)
            left, k = left[part.sizes > 16], k + 16
        return out

    def bytes_of(self, index: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes() if len(index) > 64 else self.data
        cut = (lambda a, b: raw[a:b]) if isinstance(raw, bytes) else (lambda a, b: raw[a:b].tobytes())
        return [cut(a, b) for a, b in zip(self.starts[index].tolist(), (self.starts + self.sizes)[index].tolist(), strict=True)]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts side by side (null as empty) with 32 spare bytes behind, and where each begins, the end last."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    n = int(bounds[-1] - bounds[0])
    data = np.zeros((n + 39) // 8 * 8, np.uint8)
    if n:
        data[:n] = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def runs(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Spans:
    """The longest runs of marked bytes; a text's end ends a run."""
    n = int(bounds[-1])
    inside = inside[:n]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Spans(data, starts, np.flatnonzero(ends) + 1 - starts, np.diff(np.searchsorted(starts, bounds)))


def words_of(column: pa.Array, lower: bool = False) -> Spans:
    """Runs of bytes other than ASCII white space; with ``lower``, A-Z in lower case."""
    data, bounds = text_bytes(column)
    if lower:
        data = np.frombuffer(bytearray(data.tobytes().lower()), np.uint8)
    return runs(data, bounds, ~_BLANK[data])


class WordTable:
    """Maps words to rows of arrays.

    ``learn(words)`` gets distinct words as bytes and returns one array per field, with a row per word.  ``rows(spans)``
    gives each word's row number in ``fields``, good until the next call.
    """

    def __init__(self, learn: Callable[[list[bytes]], Sequence[np.ndarray]], limit: int = WORD_LIMIT):
        self.learn, self.limit = learn, limit
        self.size = 0  # rows that are kept
        self.fields: list[np.ndarray] = []
        self.low, self.high = np.empty(limit, np.uint64), np.empty(limit, np.uint64)
        self.mask = (1 << max(4, (2 * limit - 1).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & np.uint64(self.mask)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Row numbers, -1 for words not remembered."""
        at = self._slot(low, high)
        found = self.slots[at].astype(np.int64)
        kept = np.maximum(found, 0)
        left = np.flatnonzero((found >= 0) & ((self.low[kept] != low) | (self.high[kept] != high)))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            row = self.slots[at[left]].astype(np.int64)
            found[left] = row
            kept = np.maximum(row, 0)
            left = left[(row >= 0) & ((self.low[kept] != low[left]) | (self.high[kept] != high[left]))]
        return found

    def _insert(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.low[rows], self.high[rows] = low, high
        at, left = self._slot(low, high), np.arange(len(rows))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            self.slots[at[free]] = rows[free]  # of several words for one slot, the last gets it
            left = left[self.slots[at[left]] != rows[left]]
            at[left] = (at[left] + 1) & self.mask

    def rows(self, spans: Spans) -> np.ndarray:
        low, high = spans.loads()
        size = spans.sizes
        high = np.where(size <= SHORT, high | (size.astype(np.uint64) << np.uint64(56)), np.uint64(0))  # no word of up to SHORT bytes has size 0
        found = self._find(low, high)
        wide = np.flatnonzero(size > SHORT)
        first = self.size
        gaps = np.flatnonzero((found < 0) & (size <= SHORT))
        order = gaps[np.lexsort((high[gaps], low[gaps]))]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
        new_short, new_long = order[fresh], {}
        found[order] = first + np.cumsum(fresh) - 1
        if len(wide):
            names = spans.bytes_of(wide)
            ids = np.fromiter((self.long.get(w, -1) for w in names), np.int64, len(names))
            for i in np.flatnonzero(ids < 0).tolist():
                ids[i] = first + len(new_short) + new_long.setdefault(names[i], len(new_long))
            found[wide] = ids
        if len(new_short) or new_long:
            self._learn([*spans.bytes_of(new_short), *new_long])
            self._remember(low[new_short], high[new_short], list(new_long))
        return found

    def _remember(self, low: np.ndarray, high: np.ndarray, long_words: list[bytes]) -> None:
        """Keep what was learnt last, as far as there is room."""
        if self.size + len(low) > self.limit:
            return
        self._insert(np.arange(self.size, self.size + len(low)), low, high)
        self.size += len(low)
        total = sum(map(len, long_words))
        if self.size + len(long_words) <= self.limit and self.long_bytes + total <= LONG_BYTES and max(map(len, long_words), default=0) <= LONGEST_WORD:
            self.long |= {w: self.size + k for k, w in enumerate(long_words)}
            self.long_bytes += total
            self.size += len(long_words)

    def _learn(self, new: list[bytes]) -> None:
        """Put the new words' values behind those that are remembered."""
        first = self.size
        learnt = [np.asarray(x) for x in self.learn(new)]
        if not self.fields:
            self.fields = [np.empty((0, *x.shape[1:]), x.dtype) for x in learnt]
        for k, x in enumerate(learnt):
            if first + len(new) > len(self.fields[k]):
                grown = np.empty((max(4096, int(1.5 * (first + len(new)))), *x.shape[1:]), x.dtype)
                grown[:first] = self.fields[k][:first]
                self.fields[k] = grown
            self.fields[k][first : first + len(new)] = x


_MEMORY: dict = {}


def remembered(key: object, make: Callable[[], object]) -> object:
    """What ``make`` returned for ``key``, kept by this worker until another key is asked for: workers outlive stages."""
    if key not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[key] = make()
    return _MEMORY[key]


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterable[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes (one row at least).

    After the last run, Arrow gives back to the system what it keeps of freed buffers, which else adds up over a worker's life.
    """
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    run = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()
