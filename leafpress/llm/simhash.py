"""SimHash near-duplicate detection with keys from the binary Golay code.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits.  Of up to four differing bits, at most two lie in some pair of
segments.  In the perfect Golay code of 23 bits every word is within three bits of exactly one codeword, whose 12-bit index
serves as a fuzzy hash of a segment.  Two fingerprints that differ in two bits of a pair of segments have a midpoint there, one bit from
either; so each fingerprint gets as keys the index pairs of all points within one bit of it: of its own codewords, and of
the five others that a segment three bits from its codeword reaches by one more.  Fingerprints that share a key are
compared as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.llm.interning import text_chunks, words_of
from leafpress.operators.components import connected_components
from leafpress.storage import materialize

#: Words of a shingle, seed of its hash, bits in which linked fingerprints differ at most.
WORDS_IN, SEED, DIFFER = 4, 42, 4
#: (first bit, bits) of each segment, and the pairs of segments that make keys.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = tuple(combinations(range(len(SEGMENTS)), 2))
#: Generator polynomial of the Golay code; a fixed value.
GOLAY = 0xC75
#: A key with more fingerprints is left to ``_by_midpoints``.
GROUP = 32_768
#: Larger keys that are broadcast at most.
SENT_KEYS = 1_000_000
#: In groups of up to so many, all pairs are compared side by side.
SMALL_GROUP = 16


def _mod(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of 23-bit words by the generator."""
    left = words.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GOLAY << (bit - 11)), left)
    return left


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(syndromes of the low 12 and of the high 11 bits, error and its weight by syndrome, changes of the index to the five next codewords)."""
    low, high = _mod(np.arange(1 << 12)), _mod(np.arange(1 << 11) << 12)
    errors = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)])
    error = np.zeros(1 << 11, np.int64)
    error[_mod(errors)] = errors
    messages = np.arange(1 << 12) << 11
    codewords = messages | _mod(messages)
    sevens = codewords[np.bitwise_count(codewords) == 7]
    near = np.zeros((1 << 11, 5), np.int64)
    for e in errors[np.bitwise_count(errors) == 3]:
        near[_mod(e)] = sevens[sevens & e == e] >> 11
    return low, high, error, np.bitwise_count(error), near


def decoded(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 23-bit words: the index of the codeword within three bits, whether it is three bits away, and the indices one bit further."""
    low, high, error, weight, near = golay()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    index = (words ^ error[syndrome]) >> 11
    return index, weight[syndrome] == 3, index[:, None] ^ near[syndrome]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``prints``, key): any two fingerprints that differ in up to four bits share a key."""
    found = [decoded(((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)) for at, bits in SEGMENTS]
    rows, keys = [], []
    every = np.arange(len(prints))
    for k, (a, b) in enumerate(PAIRS):
        (i, far_i, more_i), (j, far_j, more_j) = found[a], found[b]
        rows += [every, np.repeat(every[far_i], 5), np.repeat(every[far_j], 5)]
        keys += [(k << 24) | (i << 12) | j, ((k << 24) | (more_i[far_i] << 12) | j[far_i][:, None]).ravel(), ((k << 24) | (i[far_j][:, None] << 12) | more_j[far_j]).ravel()]
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint_of(column: pa.Array) -> np.ndarray:
    """Fingerprints of texts: each bit as over half of the text's shingle hashes have it; zero without words."""
    words = words_of(column, lower=True)
    total = int(words.starts[-1] + words.sizes[-1]) if len(words.starts) else 0
    # Words side by side, one blank behind each: a shingle is a run of these bytes
    edge = np.zeros(total + 1, np.int8)
    edge[words.starts] += 1
    edge[words.starts + words.sizes] -= 1
    inside = np.cumsum(edge, dtype=np.int8) > 0
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    joined = np.where(inside, words.data[: total + 1], np.uint8(0x20))[kept].tobytes()
    at = np.cumsum(kept) - 1
    starts = at[words.starts]
    ends = starts + words.sizes
    counts = np.where(words.counts >= WORDS_IN, words.counts - WORDS_IN + 1, np.minimum(words.counts, 1))
    firsts = np.repeat(np.cumsum(words.counts) - words.counts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    lasts = firsts + np.repeat(np.minimum(words.counts, WORDS_IN), counts) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[firsts].tolist(), ends[lasts].tolist(), strict=True)), np.uint64, len(firsts))
    return _majority(hashes, counts)


#: For each byte, its bits as eight bytes: sums of up to 255 of them count bits without a carry.
_SPREAD = np.ascontiguousarray(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view("<u8").ravel()


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each run of ``counts`` hashes, the bits that over half of them have."""
    parts = -(-counts // 255)
    cuts = np.repeat(np.cumsum(counts) - counts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    full = np.flatnonzero(parts)
    votes = np.zeros((len(counts), 64), np.int64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8 if len(full) else 0):
        sums = np.add.reduceat(_SPREAD[octets[:, k]], cuts).view(np.uint8).reshape(-1, 8)
        votes[full, 8 * k : 8 * k + 8] = np.add.reduceat(sums.astype(np.int64), (np.cumsum(parts) - parts)[full], axis=0)
    return np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print): a row per row, the fingerprint's bits as a long."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(fingerprint_of(chunk.column("text")).view(np.int64))], ["doc_id", "print"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, print long")


def postings(nodes: DataFrame) -> DataFrame:
    """(key, print) of the distinct fingerprints ``nodes(print)``: up to 33 rows each."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 4000):
                prints = batch.column("print")[a : a + 4000].to_numpy()
                rows, keys = keys_of(prints.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "print"])

    return nodes.select("print").mapInArrow(post, "key long, print long")


def _forest(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges that connect what links within a group connect: each fingerprint is compared with those not reached before it."""
    left, ends_a, ends_b = prints, [], []
    while len(left) > 1:
        seed, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = (np.bitwise_count(left[None, :] ^ front[:64, None]) <= DIFFER).any(axis=0)
            ends_a.append(np.full(int(hit.sum()), seed))
            ends_b.append(left[hit])
            front, left = np.concatenate([front[64:], left[hit]]), left[~hit]
    return ends_a, ends_b


def _connected(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges within runs of equal keys."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    size, place = np.repeat(sizes, sizes), np.arange(len(keys)) - np.repeat(starts, sizes)
    ends_a, ends_b = [], []
    for k in range(1, SMALL_GROUP):
        at = np.flatnonzero((size <= SMALL_GROUP) & (place + k < size))
        at = at[np.bitwise_count(prints[at] ^ prints[at + k]) <= DIFFER]
        ends_a.append(prints[at])
        ends_b.append(prints[at + k])
    for a, n in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist(), strict=True):
        p, q = _forest(prints[a : a + n])
        ends_a += p
        ends_b += q
    return np.concatenate(ends_a), np.concatenate(ends_b)


def _starred(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the first of each run of equal keys to the others."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    first = np.repeat(prints[starts], np.diff(np.append(starts, len(keys))))
    return first[first != prints], prints[first != prints]


def _by_key(rows: DataFrame, join: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], whole: bool) -> DataFrame:
    """(a, b): edges that ``join`` makes of rows (key, print) sorted by both; ``whole`` keys are handed over in one piece, others go on from their first row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in chain(batches, [None]):
            if batch is not None:
                keys, prints = np.concatenate([keys, batch.column("key").to_numpy()]), np.concatenate([prints, batch.column("print").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1])) if batch is not None else len(keys)
            ready = last if whole or batch is None else len(keys)
            if ready:
                a, b = join(keys[:ready], prints[:ready])
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
            rest = slice(last, None if whole else last + 1)
            keys, prints = keys[rest], prints[rest]

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key").sortWithinPartitions("key", "print").mapInArrow(run, "a long, b long")


def _by_midpoints(prints: DataFrame) -> DataFrame:
    """Edges between fingerprints with a common point within two bits of both, which are those that differ in up to four bits.

    Each goes to its 2081 points, so the work is in proportion to the fingerprints, however many of them link.
    """
    flips = np.array([0, *(1 << a for a in range(64)), *(1 << a | 1 << b for a, b in combinations(range(64), 2))], np.uint64)

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 64):
                own = batch.column("print")[a : a + 64].to_numpy().view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array((own[:, None] ^ flips).ravel().view(np.int64)), pa.array(np.repeat(own, len(flips)).view(np.int64))], ["key", "print"])

    return _by_key(prints.mapInArrow(spread, "key long, print long"), _starred, whole=False)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (16 lowercase hexadecimal digits) and ``component_id``, the smallest id reachable over links.

    Fingerprints link that differ in up to four bits.  Equal fingerprints are one node, so copies are never paired.  A key with up to ``group``
    fingerprints is one group, in which only edges that connect it are made; those of larger ones meet at midpoints instead.
    Null or empty text, or text without words: fingerprint zero, linked like any other.  Null id: the row stays, its component is the
    smallest id reachable, null if there is none.  Repeated rows have one component.  Other columns are ignored; an empty table gives no rows.
    """
    signed = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialize(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    posted = materialize(postings(nodes), "postings")
    large = materialize(posted.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > group).select("key"), "large")  # at most postings / group
    n_large = large.count()
    if not n_large:
        edges = _by_key(posted, _connected, whole=True)
    else:
        sent = F.broadcast(large) if n_large <= SENT_KEYS else large
        edges = _by_key(posted.join(sent, "key", "left_anti"), _connected, whole=True).union(_by_midpoints(posted.join(sent, "key", "left_semi").select("print").distinct()))
    labels = connected_components(edges)
    own = materialize(nodes.join(labels.selectExpr("node as print", "component"), "print", "left").select("print", "least", F.coalesce("component", "print").alias("component")), "own")
    found = own.join(own.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("print", "component_id")
    return signed.join(found, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
