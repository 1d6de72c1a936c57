"""Token-ID output: Parquet files of token lists, written in document order and read selectively.

Format: one row per document with ``part`` (int), ``doc_id``, ``start_in_part`` (ids before the document in
its part), ``n_tokens`` and ``tokens`` (list of int).  Parts are ascending ranges of ``doc_id``.  Token lists are
dictionary encoded (a vocabulary's ids fit one dictionary page), the ascending integers delta encoded; row
groups and pages are small enough, and pages carry indexes, so that reading some documents or only the
metadata touches few bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.llm.interning import text_chunks
from leafpress.llm.tokens import tokenizer_path, word_encoder

SCHEMA = "part int, doc_id long, start_in_part long, n_tokens long, tokens array<int>"
#: Writer settings of the format.
WRITER = {
    "compression": "snappy",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_part": "false",
}


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Consecutive runs of ``values`` as an Arrow list column."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(kind.to_pandas_dtype()) if values.dtype.itemsize == kind.bit_width // 8 else values.astype(kind.to_pandas_dtype())))


def crc32_of_lists(column: pa.ListArray) -> np.ndarray:
    """Unsigned CRC-32 of each list's ids as little-endian unsigned 32-bit integers."""
    values = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
    at = np.asarray(column.offsets, dtype=np.int64) * 4
    return np.fromiter((zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)), np.int64, len(column))


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0) -> None:
    """Encode every whole text and write the files under ``path`` in ascending order of ``id_col``.

    Null text: an empty document (its end id only).  Null ids come first; rows that share an id stay side by
    side in any order.  No rows: files without rows.  Other columns are ignored.  The text is shuffled once,
    by ranges of the id, and encoded after it; encoding first would run twice, as ranges need a sample.
    """
    tokenizer = tokenizer or tokenizer_path()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for chunk in text_chunks(batch):
                ids, sizes = word_encoder(tokenizer).encode_with_end(chunk.column("text"), end_id)
                ends = start + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sizes), part, np.int32)), chunk.column("doc_id"), pa.array(ends - sizes), pa.array(sizes), list_array(ids, sizes, pa.int32())], ["part", "doc_id", "start_in_part", "n_tokens", "tokens"])
                start = int(ends[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(encode, SCHEMA).write.options(**WRITER).parquet(path)


def read_token_files(spark: SparkSession, path: str, where: Column | str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows of the files; ``where`` on the metadata is pushed down to row groups and pages, ``columns`` prune."""
    df = spark.read.schema(SCHEMA).parquet(path)
    df = df if where is None else df.where(where)
    return df if columns is None else df.select(*columns)


def part_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, part_start): ids in all earlier parts.  Reads two metadata columns; one row per part written."""
    sums = read_token_files(spark, path, columns=["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    return sums.selectExpr("part", "sum(total) over (order by part) - total as part_start")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of its ids."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            sizes = np.diff(np.asarray(tokens.offsets, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("doc_id"), batch.column("start_in_part"), pa.array(sizes), pa.array(crc32_of_lists(tokens))], ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])

    rows = read_token_files(spark, path, columns=["part", "doc_id", "start_in_part", "tokens"]).mapInArrow(digest, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    return rows.join(part_offsets(spark, path), "part").selectExpr("doc_id", "part_start + start_in_part as start", "n_tokens", "ids_crc32")
