"""Embedding inputs, signatures, normalised vectors and exact dot products."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.functions import text as T

BATCH = 32
#: Queries and vectors that meet in one matrix product.
QUERY_BLOCK, VECTOR_BLOCK = 1024, 16_384
#: Digits of a dot product that count; the order of additions changes later ones.
DIGITS = 12


def embedding_inputs(recipes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(book, kind, ord, id, text): a card a record, and every block."""
    cards = recipes.select("book", F.lit("card").alias("kind"), F.col("ordinal").cast("long").alias("ord"), F.col("recipe_id").alias("id"), T.card_text(F.col("name"), F.col("chapter"), F.col("ingredients"), F.col("seasonings")).alias("text"))
    return cards.unionByName(blocks.select("book", F.lit("text").alias("kind"), F.col("block").cast("long").alias("ord"), F.col("bid").alias("id"), "text"))


def signature_status(now: DataFrame, report: DataFrame) -> DataFrame:
    """Per book of (book, model, dtype, sig_card, sig_text): SKIP with what differs, FAIL if the vectors are gone, else PASS.

    ``report`` also has ``present``; no report of a book: everything differs.
    """
    old = report.select("book", *(F.col(c).alias(f"old_{c}") for c in ("model", "dtype", "sig_card", "sig_text")), "present")
    rows = now.join(old, "book", "left")
    why = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"old_{c}")), c) for c in ("model", "dtype", "sig_card", "sig_text"))))
    return rows.select("book", why.alias("reasons")).join(old.select("book", "present"), "book", "left").select("book", "reasons", F.when(F.size("reasons") > 0, "SKIP").when(~F.coalesce("present", F.lit(False)), "FAIL").otherwise("PASS").alias("status"))


def batches(inputs: DataFrame, size: int = BATCH) -> DataFrame:
    """Add ``batch``, counted from 0 in a book's kind."""
    nth = F.row_number().over(Window.partitionBy("book", "kind").orderBy("ord"))
    return inputs.withColumn("batch", F.floor((nth - 1) / size).cast("int"))


def batch_calls(inputs: DataFrame, size: int = BATCH) -> DataFrame:
    return inputs.groupBy("book", "kind").agg(F.count("*").alias("inputs"), F.ceil(F.count("*") / size).alias("calls"))


def embed(inputs: DataFrame, encode: Callable[[list[str]], np.ndarray], size: int = BATCH) -> DataFrame:
    """(book, kind, id, vec) by the caller's function, called with ``size`` texts at most.  Pass only books whose signature changed."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), size):
                part = frame.iloc[a : a + size]
                yield pd.DataFrame({**{c: part[c].astype(object) for c in ("book", "kind", "id")}, "vec": pd.Series(list(np.asarray(encode(part["text"].tolist()), np.float32)), index=part.index, dtype=object)})

    return inputs.select("book", "kind", "id", "text").mapInPandas(run, "book string, kind string, id string, vec array<float>")


def norm2(vec: Column | str) -> Column:
    c = F.col(vec) if isinstance(vec, str) else vec
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def l2_normalize(vec: Column | str) -> Column:
    """Unit length; a zero vector gives null."""
    c = F.col(vec) if isinstance(vec, str) else vec
    n = norm2(c)
    return F.when(n > 0, F.transform(c, lambda x: x.cast("double") / n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_report(vectors: DataFrame, by: list[str], id_col: str = "id", vec: str = "vec") -> DataFrame:
    """Counts, unique ids, least and greatest length (4 places), and whether all are of unit length."""
    rows = vectors.select(*by, id_col, norm2(vec).alias("n2")).groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(id_col).alias("ids"), F.round(F.min("n2"), 4).alias("shortest"), F.round(F.max("n2"), 4).alias("longest"))
    return rows.withColumn("ids_unique", F.col("n") == F.col("ids")).withColumn("unit_norm", F.abs(F.col("longest") - 1) < 2e-3)


def vector_gates(vectors: DataFrame, inputs: DataFrame, signatures: DataFrame, by: list[str], id_col: str = "id", vec: str = "vec") -> DataFrame:
    """Per group of ``inputs``: whether there is a vector for each input, ids are unique, vectors are of unit length, and the
    signature changes with the model's name and with the number type.

    ``signatures``: (by, signature, other_model, other_dtype), made with the name in use and with each part changed.  A
    group without vectors fails; vectors of groups without inputs are ignored.
    """
    wanted = inputs.groupBy(*by).agg(F.count("*").alias("wanted"))
    rows = wanted.join(vector_report(vectors, by, id_col, vec), by, "left").join(signatures, by, "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    return rows.select(
        *by, no(F.col("n") == F.col("wanted")).alias("rows_match"), no(F.col("ids_unique")).alias("ids_unique"), no(F.col("unit_norm") & (F.abs(F.col("shortest") - 1) < 2e-3)).alias("unit_norm"),
        no(F.col("signature") != F.col("other_model")).alias("model_matters"), no(F.col("signature") != F.col("other_dtype")).alias("dtype_matters"),
    )


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, ties to the smaller id; only scores at or above the k-th are sorted."""
    near = np.arange(len(scores)) if k >= len(scores) else np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((own[near], -scores[near]))[:k]]


def _dealt(left: DataFrame, right: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides in blocks of bounded size, each block with each of the other side."""
    n_l, n_r = max(1, -(-left.count() // QUERY_BLOCK)), max(1, -(-right.count() // VECTOR_BLOCK))
    deal = lambda d, c, own, n, other, m: d.withColumn(own, F.expr(f"cast(pmod(xxhash64({c}), {n}) as int)")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    return deal(left, by, "qb", n_l, "vb", n_r), deal(right, "id", "vb", n_r, "qb", n_l)


def _products(q: pd.Series, v: pd.Series) -> np.ndarray:
    """All dot products; equal vectors give equal ones wherever they stand in the matrix."""
    return np.round(np.stack(q.to_numpy()).astype(np.float64) @ np.stack(v.to_numpy()).astype(np.float64).T, DIGITS)


def dot_topk(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) of (query_id, qvec) against (id, vec): exact, ties to the smaller id.

    Both sides are dealt into blocks of bounded size, and each pair of blocks is one matrix product that keeps its best
    ``k`` a query; so what is shuffled grows with queries times blocks, and no task holds a whole side.
    """
    left, right = _dealt(queries.select("query_id", "qvec"), vectors.select("id", "vec"), "query_id")
    kinds = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {vectors.schema['id'].dataType.simpleString()}, score double"

    def multiply(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": q["query_id"][:0], "id": v["id"][:0], "score": np.empty(0)})
        scores, own = _products(q["qvec"], v["vec"]), v["id"].to_numpy()
        tops = [_best(s, own, k) for s in scores]
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), [len(t) for t in tops]), "id": np.concatenate([own[t] for t in tops]), "score": np.concatenate([s[t] for s, t in zip(scores, tops, strict=True)])})

    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(multiply, kinds)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dot_places(queries: DataFrame, vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """(query_id, id, rank) of a few pairs (query_id, id): one more than the vectors that ``dot_topk`` would rank before."""
    own = pairs.join(queries.select("query_id", "qvec"), "query_id").join(vectors.select("id", "vec"), "id")
    own = own.select("query_id", F.col("id").alias("own"), "qvec", F.round(dot(F.col("qvec"), F.col("vec")), DIGITS).alias("least"))
    left, right = _dealt(own, vectors.select("id", "vec"), "query_id, own")
    kinds = f"query_id {queries.schema['query_id'].dataType.simpleString()}, own {vectors.schema['id'].dataType.simpleString()}, ahead long"

    def count(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        ahead = np.zeros(len(q), np.int64)
        if len(q) and len(v):
            scores, least, mine, others = _products(q["qvec"], v["vec"]), q["least"].to_numpy()[:, None], q["own"].to_numpy()[:, None], v["id"].to_numpy()[None, :]
            ahead = (((scores > least) & (others != mine)) | ((scores == least) & (others < mine))).sum(axis=1)
        return pd.DataFrame({"query_id": q["query_id"], "own": q["own"], "ahead": ahead})

    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(count, kinds)
    return found.groupBy("query_id", F.col("own").alias("id")).agg((F.sum("ahead") + 1).alias("rank"))
