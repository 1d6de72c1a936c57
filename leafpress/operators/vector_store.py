"""A written store of vectors that is brought up to date by encoding only what has changed.

Each row carries a digest of what its vector was made from.  A refresh joins the inputs' digests with the stored ones, encodes the
rest in full batches, and writes a new version beside the old ones; a small table names the versions that are whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafpress.operators.scan import matched
from leafpress.operators.vectors import BATCH, embed
from leafpress.storage import materialize

#: Batches that one task encodes.
BATCHES_A_TASK = 64
_KEYS = ["book", "kind", "id"]


def input_digest(model: str, dtype: str, text: str = "text") -> Column:
    """What a vector depends on: the model's name, the number type and the text (null apart from empty)."""
    return F.sha2(F.concat(F.lit(f"{model}\0{dtype}\0"), F.when(F.col(text).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(text)))), 256)


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """(version, n, encoded, dropped) of the whole versions, or None before the first."""
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return None
    return spark.read.schema("version long, n long, encoded long, dropped long").parquet(f"{path}/versions")


def read_store(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """(book, kind, id, digest, vec) of a version, the last whole one if none is named."""
    known = versions(spark, path)
    if known is None:
        return None
    return spark.read.parquet(f"{path}/vectors-{known.agg(F.max('version')).first()[0] if version is None else version}")


def changed_inputs(inputs: DataFrame, stored: DataFrame | None, model: str, dtype: str) -> tuple[DataFrame, DataFrame | None]:
    """(inputs whose digest is new, stored rows that still hold), of inputs (book, kind, id, text) with unique keys."""
    now = materialize(inputs.select(*_KEYS, "text", input_digest(model, dtype).alias("digest")), "inputs")
    if stored is None:
        return now, None
    keys = [*_KEYS, "digest"]
    return _where(now, stored.select(*keys), keys, "left_anti"), _where(stored, now.select(*keys), keys, "left_semi")


def _where(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows of ``left`` that have or lack a row with the same keys, null equal to null."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    both = F.lit(True)
    for k in keys:
        both = both & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(other, both, how)


def refresh(inputs: DataFrame, path: str, encode: Callable[[list[str]], np.ndarray], model: str, dtype: str, size: int = BATCH) -> DataFrame:
    """Bring the store at ``path`` up to date with inputs (book, kind, id, text), and return its new version's rows.

    Only inputs whose text, model or number type changed are encoded, ``size`` at most a call; vectors without an input are dropped.
    Without any change no version is written.  A null text is not encoded and has no vector.  A refresh that fails leaves
    the last whole version as it was.
    """
    spark = inputs.sparkSession
    stored = read_store(spark, path)
    fresh, held = changed_inputs(inputs.where("text is not null"), stored, model, dtype)
    fresh = materialize(fresh, "fresh")
    n, before, kept = fresh.count(), stored.count() if stored is not None else 0, held.count() if held is not None else 0
    if stored is not None and not n and kept == before:
        return stored
    vectors = embed(fresh.repartition(max(1, -(-n // (size * BATCHES_A_TASK)))), encode, size)
    made = _joined(vectors, fresh)
    known = versions(spark, path)
    version = 1 + (known.agg(F.max("version")).first()[0] if known is not None else 0)
    rows = made if held is None else made.unionByName(held.select(*made.columns))
    rows.write.mode("overwrite").parquet(f"{path}/vectors-{version}")
    spark.createDataFrame([(version, n + kept, n, before - kept)], "version long, n long, encoded long, dropped long").coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return read_store(spark, path, version)


def _joined(vectors: DataFrame, fresh: DataFrame) -> DataFrame:
    return matched(vectors, fresh.select(*_KEYS, "digest"), _KEYS).select(*_KEYS, "digest", "vec")
