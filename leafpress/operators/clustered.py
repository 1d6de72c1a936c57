"""Exact best dot products with clusters of vectors: a cluster that cannot reach a query's k-th score is not multiplied.

A vector within ``radius`` of its cluster's centre has a dot product with q of at most q·centre + |q|·radius.  A query first meets the
clusters with the highest such bounds until they hold k vectors; its k-th score there tells which other clusters it must still meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafpress.operators.vectors import VECTOR_BLOCK, _best, _products
from leafpress.storage import materialize

#: Centres, drawn by a hash of the id; they are sent to all tasks.
CENTRES = 1024
#: What rounding may add to a product, as a share of its bound.
SLACK = 1e-9


@dataclass
class Clusters:
    """Vectors (cluster, block, id, vec) in a written table, and what bounds each cluster."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray

    @property
    def blocks(self) -> np.ndarray:
        return -(-self.sizes // VECTOR_BLOCK)


def cluster(vectors: DataFrame, centres: int = CENTRES) -> Clusters:
    """Deal vectors (id, vec) to the nearest of ``centres`` of them.  Null vectors are left out; large clusters lie in several blocks."""
    held = vectors.where("vec is not null").select("id", "vec")
    drawn = held.select(F.xxhash64("id").alias("h"), "vec").orderBy("h").limit(centres).toPandas()  # bounded by ``centres``
    points = np.unique(np.stack(drawn["vec"].to_numpy()).astype(np.float64), axis=0) if len(drawn) else np.zeros((0, 0))
    sent = vectors.sparkSession.sparkContext.broadcast(points)

    def assign(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points = sent.value
        for frame in frames:
            own = np.stack(frame["vec"].to_numpy()).astype(np.float64) if len(frame) else np.zeros((0, points.shape[1]))
            near = ((points**2).sum(axis=1) - 2 * own @ points.T).argmin(axis=1)
            yield frame.assign(cluster=near, away=np.linalg.norm(own - points[near], axis=1))

    kind = held.schema["id"].dataType.simpleString()
    rows = materialize(held.mapInPandas(assign, f"id {kind}, vec {held.schema['vec'].dataType.simpleString()}, cluster long, away double"), "clustered")
    told = rows.groupBy("cluster").agg(F.max("away").alias("radius"), F.count("*").alias("n")).toPandas()  # a row a centre
    radius, sizes = np.zeros(len(points)), np.zeros(len(points), np.int64)
    radius[told["cluster"].to_numpy(int)], sizes[told["cluster"].to_numpy(int)] = told["radius"], told["n"]
    counts = F.create_map(*(F.lit(x) for c, n in enumerate(-(-sizes // VECTOR_BLOCK)) if n > 1 for x in (c, int(n)))) if (sizes > VECTOR_BLOCK).any() else None
    block = F.lit(0) if counts is None else F.pmod(F.xxhash64("id"), F.coalesce(counts[F.col("cluster").cast("int")], F.lit(1))).cast("int")
    return Clusters(rows.select("cluster", block.alias("block"), "id", "vec"), points, radius, sizes)


def _asked(queries: DataFrame, held: Clusters, k: int, second: bool) -> DataFrame:
    """(query_id, qvec, cluster, block): which blocks a query meets in the first or the ``second`` round, where it has ``least``, its k-th score."""
    sent = queries.sparkSession.sparkContext.broadcast((held.centres, held.radius, held.sizes, held.blocks))

    def choose(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, radius, sizes, blocks = sent.value
        for frame in frames:
            if not len(frame) or not len(centres):
                continue
            q = np.stack(frame["qvec"].to_numpy()).astype(np.float64)
            reach = np.linalg.norm(q, axis=1)[:, None] * (radius + np.linalg.norm(centres, axis=1))[None, :]
            bound = q @ centres.T + np.linalg.norm(q, axis=1)[:, None] * radius[None, :] + SLACK * (1 + reach)
            order = np.argsort(-bound, axis=1, kind="stable")
            ahead = np.cumsum(sizes[order], axis=1) - sizes[order]
            first = np.zeros(bound.shape, bool)
            np.put_along_axis(first, order, ahead < k, axis=1)
            meets = ~first & (bound >= frame["least"].fillna(-np.inf).to_numpy()[:, None]) if second else first
            row, at = np.nonzero(meets & (sizes > 0)[None, :])
            times = blocks[at]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, at = np.repeat(row, times), np.repeat(at, times)
            yield pd.DataFrame({"query_id": frame["query_id"].to_numpy()[row], "qvec": frame["qvec"].to_numpy()[row], "cluster": at, "block": block.astype(np.int32)})

    kind = f"query_id {queries.schema['query_id'].dataType.simpleString()}, qvec {queries.schema['qvec'].dataType.simpleString()}, cluster long, block int"
    return queries.mapInPandas(choose, kind)


def _multiplied(asked: DataFrame, held: Clusters, k: int) -> DataFrame:
    """(query_id, id, score, products): the best ``k`` of each block for each query that meets it; ``products`` on the first of them counts what was computed."""
    kinds = f"query_id {asked.schema['query_id'].dataType.simpleString()}, id {held.rows.schema['id'].dataType.simpleString()}, score double, products long"

    def multiply(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": q["query_id"][:0], "id": v["id"][:0], "score": np.empty(0), "products": np.empty(0, np.int64)})
        scores, own = _products(q["qvec"], v["vec"]), v["id"].to_numpy()
        tops = [_best(s, own, k) for s in scores]
        counted = np.concatenate([np.r_[len(own), np.zeros(len(t) - 1, np.int64)] for t in tops])
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), [len(t) for t in tops]), "id": np.concatenate([own[t] for t in tops]), "score": np.concatenate([s[t] for s, t in zip(scores, tops, strict=True)]), "products": counted})

    return asked.groupBy("cluster", "block").cogroup(held.rows.groupBy("cluster", "block")).applyInPandas(multiply, kinds)


def dot_topk(queries: DataFrame, held: Clusters, k: int) -> DataFrame:
    """(query_id, id, score, rank, share) like ``vectors.dot_topk`` of (query_id, qvec) against all vectors of ``held``.

    ``share`` is the part of all products of queries with vectors that was computed.  A query without a vector has no rows.
    """
    asked = queries.where("qvec is not null").select("query_id", "qvec")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    first = materialize(_multiplied(_asked(asked.withColumn("least", F.lit(None).cast("double")), held, k, False), held, k), "first_round")
    kth = first.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query_id", F.col("score").alias("least"))
    rows = materialize(first.unionByName(_multiplied(_asked(asked.join(kth, "query_id", "left"), held, k, True), held, k)), "both_rounds")
    computed, n = rows.agg(F.sum("products")).first()[0] or 0, asked.count()
    best = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "id", "score", "rank", F.lit(computed / max(1, n * int(held.sizes.sum()))).alias("share"))
