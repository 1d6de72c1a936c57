"""Ranked lexical search: a written index of document shards, scored term at a time.

The index holds a row per shard, in compressed sparse rows: its terms, and per term the documents that hold it with an integer impact
each.  An impact needs the document's length and the corpus' mean only, so it is computed when the index is written; how rare a term is comes in as an
integer weight per term of a query.  A shard is scored alone: a dense row of sums per query, to which each term adds its
list.  The best of a shard go on, and the best of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafpress.llm.interning import Spans, runs, text_bytes, text_chunks

#: A shard ends at so many documents (their numbers take 16 bits) or bytes of text, whichever comes first; a longer text is a shard of its own.
SHARD_DOCS, SHARD_BYTES = 1 << 16, 16_000_000
#: Characters of queries that are sent to the shards at once; further queries make further passes over the index.
SENT_CHARS = 4_000_000
#: Part of a document's impact that follows its length, in hundredths; the other part is fixed.
LENGTH_PART = 90

_TERM = np.zeros(256, bool)
_TERM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True

_SHARD = "doc_ids array<long>, terms binary, term_ends binary, list_ends binary, docs binary, impacts binary"


def terms_of(column: pa.Array) -> Spans:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    data, bounds = text_bytes(column)
    data = np.frombuffer(bytearray(data.tobytes().lower()), np.uint8)
    return runs(data, bounds, _TERM[data])


def _names(spans: Spans) -> pa.DictionaryArray:
    """The terms as strings of bytes, equal ones numbered alike."""
    cuts = np.stack([spans.starts, spans.starts + spans.sizes], axis=1).astype(np.int64).ravel()
    if not len(cuts):
        return pa.array([], pa.large_binary()).dictionary_encode()
    between = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(spans.data)])
    return between.take(pa.array(np.arange(0, len(cuts) - 1, 2))).dictionary_encode()


@dataclass
class _Part:
    """What a chunk of texts gives: its distinct terms and, per (term, document), how often."""

    names: pa.Array
    term: np.ndarray
    doc: np.ndarray
    often: np.ndarray
    sizes: np.ndarray
    ids: pa.Array


def _part(chunk: pa.RecordBatch) -> _Part:
    spans = terms_of(chunk.column("text"))
    coded = _names(spans)
    keys, often = np.unique(coded.indices.to_numpy().astype(np.int64) * len(chunk) + spans.of_text(), return_counts=True)
    return _Part(coded.dictionary, keys // len(chunk), keys % len(chunk), often, spans.counts, chunk.column("doc_id"))


def impact(often: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``often`` occurrences in documents of ``size`` terms count, before the term's weight."""
    length = 100 - LENGTH_PART + (LENGTH_PART * size * n_docs) // max(1, n_terms)
    return (1_000_000_000 * often) // (1000 * often + 8 * length)


def weight(df: int, n_docs: int) -> int:
    """A rare term weighs more than a frequent one."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _shard(parts: list[_Part], n_docs: int, n_terms: int) -> pa.RecordBatch:
    """Parts as one row; documents are numbered by ascending id (null last), which decides ties."""
    ids = pa.concat_arrays([p.ids for p in parts])
    sizes = np.concatenate([p.sizes for p in parts])
    number = np.empty(len(ids), np.int64)
    number[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    first = np.cumsum([0, *(len(p.ids) for p in parts)])
    doc = np.concatenate([p.doc + a for p, a in zip(parts, first, strict=False)])
    names = pa.concat_arrays([p.names for p in parts]).dictionary_encode()
    known, base = names.indices.to_numpy().astype(np.int64), np.cumsum([0, *(len(p.names) for p in parts)])
    term = np.concatenate([known[p.term + a] for p, a in zip(parts, base, strict=False)])
    often = np.concatenate([p.often for p in parts]).astype(np.int64)
    order = np.argsort(term * len(ids) + number[doc], kind="stable")
    lists = np.cumsum(np.bincount(term, minlength=len(names.dictionary))).astype("<u4")
    spelt, term_ends = text_bytes(names.dictionary)
    impacts = impact(often, sizes[doc].astype(np.int64), n_docs, n_terms)[order].astype("<u4")
    blobs = [spelt[: term_ends[-1]].tobytes(), term_ends[1:].astype("<u4").tobytes(), lists.tobytes(), number[doc][order].astype("<u2").tobytes(), impacts.tobytes()]
    own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pc.sort_indices(ids, null_placement="at_end")))
    return pa.RecordBatch.from_arrays([own, *(pa.array([b], pa.binary()) for b in blobs)], ["doc_ids", "terms", "term_ends", "list_ends", "docs", "impacts"])


def corpus_counts(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """How many rows hold a term, and how many terms they hold together."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [terms_of(chunk.column("text")).counts for chunk in text_chunks(batch)]
            n = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["n_docs", "n_terms"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return found[0] or 0, found[1] or 0


def write_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the shards of all rows, and the counts of the corpus, under ``path``.

    Null or empty text, or text without terms: in no shard.  Repeated rows are documents of their own.  Other columns are ignored;
    an empty table gives an index without shards.
    """
    n_docs, n_terms = corpus_counts(docs, text_col)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[_Part] = []
        n = size = 0
        for batch in batches:
            for chunk in text_chunks(batch):
                for a in range(0, len(chunk), shard_docs):
                    piece = chunk.slice(a, shard_docs)
                    if parts and (n + len(piece) > shard_docs or size >= shard_bytes):
                        yield _shard(parts, n_docs, n_terms)
                        parts, n, size = [], 0, 0
                    parts.append(_part(piece))
                    n, size = n + len(piece), size + piece.column("text").nbytes
        if parts:
            yield _shard(parts, n_docs, n_terms)
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows.mapInArrow(build, _SHARD).write.option("compression", "zstd").option("parquet.block.size", 2 * SHARD_BYTES).parquet(f"{path}/shards")
    spark = docs.sparkSession
    spark.createDataFrame([(n_docs, n_terms)], "n_docs long, n_terms long").coalesce(1).write.parquet(f"{path}/counts")


def _shard_terms(row: pa.RecordBatch, at: int) -> tuple[pa.Array, np.ndarray]:
    """A shard's terms, and where each one's list begins, the end of the last one behind."""
    blob = row.column("terms")[at].as_buffer()
    ends = np.frombuffer(row.column("term_ends")[at].as_buffer(), "<u4")
    cuts = np.append(0, ends).astype(np.int64)
    lists = np.append(0, np.frombuffer(row.column("list_ends")[at].as_buffer(), "<u4").astype(np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), blob]), lists


def _frequencies(index: DataFrame, vocabulary: pa.Array) -> np.ndarray:
    """In how many documents each term of ``vocabulary`` is."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                terms, lists = _shard_terms(batch, i)
                at = pc.index_in(sent.value, value_set=terms).fill_null(-1).to_numpy()
                total[at >= 0] += np.diff(lists)[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in index.select("terms", "term_ends", "list_ends").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


def _best(sums: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest sums above zero, largest first, ties by place."""
    least = 1
    if len(sums) > k:
        top = np.argpartition(sums, len(sums) - k)[len(sums) - k :]
        least = max(1, int(sums[top].min()))
    found = np.flatnonzero(sums >= least)  # all that tie with the last one
    return found[np.argsort(-sums[found], kind="stable")][:k]


def _scored(index: DataFrame, names: pa.Array, item: np.ndarray, term: np.ndarray, vocabulary: pa.Array, weights: np.ndarray, k: int) -> DataFrame:
    """(query, item_id, doc_id, score): the best of each shard for each query; (item, term) say which terms a query has, by query."""
    sent = index.sparkSession.sparkContext.broadcast((names, np.searchsorted(item, np.arange(len(names) + 1)), term, vocabulary, weights))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bounds, term, vocabulary, weights = sent.value
        for batch in batches:
            for i in range(len(batch) if len(names) else 0):
                terms, lists = _shard_terms(batch, i)
                at = pc.index_in(vocabulary, value_set=terms).fill_null(-1).to_numpy()
                docs, impacts = np.frombuffer(batch.column("docs")[i].as_buffer(), "<u2"), np.frombuffer(batch.column("impacts")[i].as_buffer(), "<u4")
                ids = batch.column("doc_ids")[i].values
                weighed = {t: (docs[lists[a] : lists[a + 1]], impacts[lists[a] : lists[a + 1]] * weights[t]) for t, a in enumerate(at.tolist()) if a >= 0 and weights[t]}
                query, doc, sums = [], [], []
                for q in range(len(names)):
                    row = np.zeros(len(ids), np.int64)
                    for t in term[bounds[q] : bounds[q + 1]].tolist():
                        if t in weighed:
                            row[weighed[t][0]] += weighed[t][1]  # a term has a document once
                    found = _best(row, k)
                    query.append(np.full(len(found), q))
                    doc.append(found)
                    sums.append(row[found])
                query, doc = pa.array(np.concatenate(query)), pa.array(np.concatenate(doc))
                yield pa.RecordBatch.from_arrays([query, names.take(query), ids.take(doc), pa.array(np.concatenate(sums))], ["query", "item_id", "doc_id", "score"])

    return index.mapInArrow(score, "query long, item_id long, doc_id long, score long")


def _asked(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """(item ids, item and term of each distinct pair by item, distinct terms) of a bounded block of queries."""
    ids = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    spans = terms_of(rows.column("text").combine_chunks())
    coded = _names(spans)
    n = max(1, len(coded.dictionary))
    pairs = np.unique(ids.indices.to_numpy()[spans.of_text()].astype(np.int64) * n + coded.indices.to_numpy())
    return ids.dictionary, pairs // n, pairs % n, coded.dictionary


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", sent_chars: int = SENT_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` best documents of the index at ``path``, ties by ascending id.

    A score sums, over the distinct terms of an item, the term's weight times its impact.  Documents with score 0 are no hits.  Rows of one
    item id (null is an id of its own) are one item with the terms of all.  Null or empty text, or text without terms: no rows.  A document
    without an id comes behind those that it ties with.
    """
    index, counts = spark.read.parquet(f"{path}/shards"), spark.read.parquet(f"{path}/counts").first()
    asked = queries.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    blocks = max(1, math.ceil((asked.agg(F.sum(F.length("text"))).first()[0] or 0) / sent_chars))
    hits = None
    for block in range(blocks):
        names, item, term, vocabulary = _asked(asked.where(f"pmod(xxhash64(item_id), {blocks}) = {block}").toArrow())
        weights = np.array([weight(int(df), counts["n_docs"]) for df in _frequencies(index, vocabulary)], np.int64)
        one = _scored(index, names, item, term, vocabulary, weights, k)
        one = one.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
        one = one.select("item_id", "rank", "doc_id", "score")
        hits = one if hits is None else hits.unionByName(one)
    return hits
