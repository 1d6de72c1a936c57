"""Best-fit packing of token pieces into fixed-length sequences by minimum bin slack.

Lengths are at most the capacity, so a histogram of lengths has at most ``capacity`` rows however many pieces
there are.  The driver packs that histogram: per bin, the largest length left is completed by the fullest
combination of the others, found by subset sums over a bitset, and that combination is repeated as long as its
lengths last.  The tasks then place their own pieces by rank; no piece passes through the driver.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.llm.interning import text_chunks
from leafpress.llm.token_files import crc32_of_lists, list_array
from leafpress.llm.tokens import tokenizer_path, word_encoder

PIECES = "part int, rank_in_part long, doc_id long, piece int, start long, length long, ids array<int>"


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how often, of the largest sum up to ``room``; of equal sums, the one with the largest lengths."""
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    full, reach, after = (1 << (room + 1)) - 1, 1, [1]
    for x in lengths:
        left, k = min(counts[x], room // x), 1
        while left:
            k = min(k, left)
            reach |= (reach << (x * k)) & full
            left, k = left - k, 2 * k
        after.append(reach)
    at, chosen = reach.bit_length() - 1, {}
    for i in range(len(lengths) - 1, -1, -1):
        x, n = lengths[i], 0
        most = min(counts[x], at // x)
        below = after[i]
        n = next((k for k in range(most, -1, -1) if below >> (at - k * x) & 1), 0)
        if n:
            chosen[x] = n
            at -= n * x
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, number of bins filled with it): at most a few combinations for each possible length."""
    counts, plan = {x: n for x, n in histogram.items() if n}, []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        combination = fullest(counts, capacity - seed)
        counts[seed] += 1
        combination[seed] = combination.get(seed, 0) + 1
        bins = min(counts[x] // n for x, n in combination.items())
        plan.append((combination, bins))
        for x, n in combination.items():
            counts[x] -= n * bins
            if not counts[x]:
                del counts[x]
    return plan


def placement(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks of one length that fill one place of consecutive bins: length, first rank, first bin, offset."""
    rows, ranks, first_bin = [], {}, 0
    for combination, bins in plan:
        offset = 0
        for x in sorted(combination, reverse=True):
            for _ in range(combination[x]):
                rows.append((x, ranks.get(x, 0), first_bin, offset))
                ranks[x] = ranks.get(x, 0) + bins
                offset += x
        first_bin += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "bin": table[:, 2], "offset": table[:, 3]}


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Token pieces of each text: whole if it fits, else cut from its end into full pieces, the first one shorter.

    ``part`` and ``rank_in_part`` number the pieces of one length within a task; write the result once
    (``materialize``) before packing it.  Null text: the end id alone.  Null or repeated ids pass through.
    """
    tokenizer = tokenizer or tokenizer_path()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for chunk in text_chunks(batch):
                ids, sizes = word_encoder(tokenizer).encode_with_end(chunk.column("text"), end_id)
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (sizes - (pieces - 1) * capacity)[doc]
                length = np.where(number == 0, head, capacity)
                start = np.where(number == 0, 0, head + (number - 1) * capacity)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered) + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), part, np.int32)), pa.array(rank), chunk.column("doc_id").take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), list_array(ids, length, pa.int32())],
                    ["part", "rank_in_part", "doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32`` (unsigned, over little-endian unsigned 32-bit ids)."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(crc32_of_lists(batch.column("ids")))], [*kept, "ids_crc32"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "ids")
    return pieces.mapInArrow(digest, f"{schema}, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = 1024, written: DataFrame | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table with ``part``, ``rank_in_part`` and ``length`` (1 to capacity).

    ``written`` is the table that ``pieces`` was derived from row by row, if it was: lengths are then counted there.
    Pieces of a sequence lie gapless from 0.  Other columns pass through; an empty table stays empty.
    """
    counts = (pieces if written is None else written).groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row per length: 1 to capacity
    runs = placement(plan_bins(histogram, capacity))
    #: Exact while one length has under 2**50 pieces.
    wide = 1 << 50
    starts = runs["length"] * wide + runs["rank"]
    before, place_in_length = f"__before_{uuid.uuid4().hex}", f"__rank_{uuid.uuid4().hex}"
    bases = counts.selectExpr("part", "length", f"sum(n) over (partition by length order by part) - n as {before}")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", place_in_length))
            run = np.searchsorted(starts, length * wide + rank, side="right") - 1
            kept = [n for n in batch.schema.names if n != place_in_length]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(runs["bin"][run] + rank - runs["rank"][run]), pa.array(runs["offset"][run])], [*kept, "sequence_id", "offset"])

    others = [c for c in pieces.columns if c not in ("part", "rank_in_part", "sequence_id", "offset")]
    ranked = pieces.join(bases, ["part", "length"]).select(*(F.col(f"`{c}`") for c in others), (F.col(before) + F.col("rank_in_part")).alias(place_in_length))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != place_in_length)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def least_bins(histogram: dict[int, int], capacity: int) -> int:
    """A bound below which no packing can go."""
    return max(math.ceil(sum(x * n for x, n in histogram.items()) / capacity), sum(n for x, n in histogram.items() if 2 * x > capacity))
