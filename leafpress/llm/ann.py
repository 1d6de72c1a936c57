"""Approximate nearest neighbours by inner product: stable projections, a kd-tree, and a chi-square stopping test.

An added component makes every vector as long as the longest, so that a larger inner product is a smaller distance.
Gaussian projections to a few dimensions keep a pair's squared distance but for a chi-square factor.  The projected points
lie in the cells of a kd-tree.  A query verifies points on their original vectors in order of projected distance and stops when the next
one's would, with the wanted probability, be exceeded by that of any point nearer than the k-th found.  Queries are
verified in blocks, by matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.storage import materialize

PROJECTIONS, CONFIDENCE = 16, 0.95
#: Points that the tree's splits are learnt on at most; all points are indexed.  Wanted points in a cell, most rows in a block of a
#: cell, most visitors that one task compares with it.
SAMPLE, CELL_ROWS, BLOCK_ROWS, VISITORS = 20_000, 8_000, 16_384, 2_048
#: Cells that a query visits before it has a distance to stop by; queries that are compared at once.
FIRST_CELLS, AT_ONCE = 1, 128


def chi_square_quantile(p: float, m: int) -> float:
    """By bisection on the series of the regularised lower incomplete gamma function."""

    def cdf(x: float) -> float:
        a, y = m / 2, x / 2
        term = total = 1 / a
        for n in range(1, 500):
            term *= y / (a + n)
            total += term
        return total * math.exp(-y + a * math.log(y) - math.lgamma(a))

    low, high = 1e-9, 20.0 * m + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


@dataclass
class Tree:
    """Splits of projected space; node 0 is the root, children of node i stand at 2i + 1 and 2i + 2."""

    axis: np.ndarray  # -1: a leaf
    at: np.ndarray
    matrix: np.ndarray
    longest: float  # squared length that all vectors are brought to

    @staticmethod
    def fit(vectors: np.ndarray, rows: int, longest: float, dims: int) -> Tree:
        matrix = np.random.default_rng(20240607).standard_normal((dims + 1, PROJECTIONS))
        tree = Tree(np.empty(0), np.empty(0), matrix, longest)
        points = tree.project(vectors)
        depth = max(0, math.ceil(math.log2(max(1, min(rows / CELL_ROWS, len(points) / 8)))))
        tree.axis, tree.at = np.full(2 ** (depth + 1) - 1, -1), np.zeros(2 ** (depth + 1) - 1)
        held = {0: np.arange(len(points))}
        for node in range(2**depth - 1):
            index = held.pop(node)
            own = points[index]
            axis = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
            tree.axis[node], tree.at[node] = axis, float(np.median(own[:, axis])) if len(own) else 0.0
            left = own[:, axis] < tree.at[node]
            held[2 * node + 1], held[2 * node + 2] = index[left], index[~left]
        return tree

    def project(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        norms = (vectors * vectors).sum(axis=1)
        extra = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(0.0, self.longest - norms))
        return vectors @ self.matrix[:-1] + extra[:, None] * self.matrix[-1]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(node) and (inner := self.axis[node] >= 0).any():
            axis = np.maximum(self.axis[node], 0)
            right = points[np.arange(len(points)), axis] >= self.at[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        return node


def usable(vec: str) -> Column:
    """Not null, not zero, without null or non-finite components."""
    return F.expr(f"{vec} is not null and size({vec}) > 0 and forall({vec}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists({vec}, x -> x <> 0)")


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found rows of ``df`` but those of its own id.

    Nearness is the largest inner product in double precision, ties to the smaller id.  Vectors that are null, zero, hold null or
    non-finite components, or have another length than most, and rows with null ids, take no part.  Equal vectors are separate
    candidates; repeated ids count as rows.  Other columns are ignored; no rows or no queries: no rows.
    """
    spark = df.sparkSession
    kind = df.schema[vec_col].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    clean = lambda d: d.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec")).where(usable("vec") & F.col("id").isNotNull())
    square = "aggregate(vec, 0D, (a, x) -> a + double(x) * double(x))"
    common = clean(df).groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n"), F.max(F.expr(square)).alias("longest")).orderBy(F.desc("n"), "dims").limit(1).collect()
    if not common:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, n, longest = (common[0][x] for x in ("dims", "n", "longest"))
    rows = clean(df).where(F.size("vec") == dims)
    share = min(1.0, SAMPLE / n)
    sample = rows.where(F.xxhash64("id", F.lit(5)) <= int(-(2**63) + share * (2.0**64 - 2**12))).select("vec").limit(2 * SAMPLE).toArrow()  # about SAMPLE rows
    tree = Tree.fit(_matrix(sample.column("vec"), dims), n, longest, dims)
    sent = spark.sparkContext.broadcast(tree)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = sent.value.project(_matrix(batch.column("vec"), dims))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), PROJECTIONS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.cells(points)), batch.column("id"), batch.column("vec"), lists], ["cell", "id", "vec", "point"])

    points = materialize(rows.mapInArrow(place, f"cell long, id long, vec {kind}, point array<double>"), "points")
    edges = [f(F.col("point")[i]).alias(f"{name}{i}") for i in range(PROJECTIONS) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = points.groupBy("cell").agg(F.count("*").alias("n"), *edges).orderBy("cell").toPandas()  # a row a leaf of the tree: at most a quarter of the sample
    low, high = (boxes[[f"{name}{i}" for i in range(PROJECTIONS)]].to_numpy() for name in ("lo", "hi"))
    cells, blocks = boxes["cell"].to_numpy(), np.maximum(1, -(-boxes["n"].to_numpy() // BLOCK_ROWS))
    quantile = chi_square_quantile(confidence, PROJECTIONS)
    shape = spark.sparkContext.broadcast((low, high, cells, blocks))

    def route(first: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """The first cells of each query by the distance of their boxes; or all others within its stopping distance."""

        def go(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, cells, blocks = shape.value
            for batch in batches:
                q = sent.value.project(_matrix(batch.column("vec"), dims), queries=True)
                reach = quantile * batch.column("bound").to_numpy(zero_copy_only=False)
                for a in range(0, len(q), AT_ONCE):
                    part = q[a : a + AT_ONCE, None, :]
                    gap = np.maximum(0.0, np.maximum(low - part, part - high))
                    far = (gap * gap).sum(axis=2)
                    place = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1, kind="stable")
                    row, cell = np.nonzero(place < FIRST_CELLS if first else (place >= FIRST_CELLS) & (far <= reach[a : a + AT_ONCE, None]))
                    times = blocks[cell]
                    block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    row, cell = np.repeat(row + a, times), np.repeat(cell, times)
                    yield pa.RecordBatch.from_arrays([pa.array(cells[cell]), pa.array(block.astype(np.int32)), *(batch.column(c).take(pa.array(row)) for c in ("id", "vec", "bound"))], ["cell", "block", "qid", "qvec", "bound"])

        return go

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        """Queries against one block of a cell: in order of projected distance, until the stopping test holds."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(left) and len(right):
            vectors, ids = _matrix(right.column("vec"), dims), right.column("id").to_numpy()
            points, queries, qids, bounds = sent.value.project(vectors), _matrix(left.column("qvec"), dims), left.column("qid").to_numpy(), left.column("bound").to_numpy()
            lengths = (points * points).sum(axis=1)
            for a in range(0, len(left), AT_ONCE):
                q, qid, bound = queries[a : a + AT_ONCE], qids[a : a + AT_ONCE], bounds[a : a + AT_ONCE]
                p = sent.value.project(q, queries=True)
                gap = np.maximum(0.0, lengths + (p * p).sum(axis=1)[:, None] - 2 * p @ points.T)
                found.append(_verified(q, qid, bound, gap, vectors, ids, longest, quantile, k))
        query, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"query_id": query, "vec_id": vec, "score": score})

    in_blocks = points.join(points.groupBy("cell").agg(F.expr(f"ceil(count(*) / {BLOCK_ROWS})").alias("blocks")), "cell").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))

    def visit(asked: DataFrame, first: bool) -> DataFrame:
        """A cell with many visitors is read by groups of them, so that no group grows with the table."""
        routed = materialize(asked.mapInArrow(route(first), f"cell long, block int, qid long, qvec {kind}, bound double"), "visits")
        groups = routed.groupBy("cell", "block").count().selectExpr("cell", "block", f"cast(ceil(count / {VISITORS}) as int) as parts")
        left = routed.join(groups, ["cell", "block"]).withColumn("part", F.expr("cast(pmod(xxhash64(qid), parts) as int)")).drop("parts")
        right = in_blocks.join(groups, ["cell", "block"]).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select("cell", "block", "part", "id", "vec")
        return left.groupBy("cell", "block", "part").cogroup(right.groupBy("cell", "block", "part")).applyInArrow(verify, "query_id long, vec_id long, score double")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda d: d.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = clean(queries).where(F.size("vec") == dims)
    first = materialize(best(visit(asked.withColumn("bound", F.lit(float("inf"))), True)).drop("rank"), "first")
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("last"))
    bound = F.expr(f"coalesce(greatest(0D, {longest!r}D + {square} - 2 * last) * (1 + 1e-9D), double('infinity'))")
    again = asked.join(kth, asked["id"] == kth["query_id"], "left").select("id", "vec", bound.alias("bound"))
    return best(first.unionByName(visit(again, False))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _verified(q: np.ndarray, qid: np.ndarray, bound: np.ndarray, gap: np.ndarray, vectors: np.ndarray, ids: np.ndarray, longest: float, quantile: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's ``k`` nearest verified rows within its bound, more where scores are equal.

    ``gap`` holds squared projected distances.  The first rows verified are those that are nearest in projection; as their distances
    tighten the bound, so do they the projected distance up to which rows are verified.
    """
    gap[qid[:, None] == ids] = np.inf
    base = longest + (q * q).sum(axis=1)
    few = min(k, gap.shape[1])
    near = np.argpartition(gap, few - 1, axis=1)[:, :few]
    if few == k:
        known = base[:, None] - 2 * np.einsum("ijk,ik->ij", vectors[near], q)
        known[np.isinf(np.take_along_axis(gap, near, axis=1))] = np.inf
        bound = np.minimum(bound, np.maximum(0.0, known.max(axis=1)) * (1 + 1e-9))
    reach = (quantile * bound)[:, None]
    columns = np.flatnonzero((gap <= reach).any(axis=0))
    if not len(columns):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    gap = gap[:, columns]
    far = base[:, None] - 2 * q @ vectors[columns].T
    far[(gap > reach) | np.isinf(gap)] = np.inf
    if len(columns) >= k:
        bound = np.minimum(bound, np.maximum(0.0, np.partition(far, k - 1, axis=1)[:, k - 1]) * (1 + 1e-9) + 1e-12)
    i, j = np.nonzero((far <= bound[:, None]) & np.isfinite(far) & (gap <= (quantile * bound)[:, None]))
    score = (vectors[columns[j]] * q[i]).sum(axis=1)
    order = np.lexsort((ids[columns[j]], -score, i))
    i, j, score = i[order], j[order], score[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < k
    return qid[i[kept]], ids[columns[j[kept]]], score[kept]
