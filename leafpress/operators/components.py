"""Connected components of an edge table, by smallest labels or by alternating stars.

``connected_components`` passes smallest labels along edges: few steps a round, and each round deals out all edges again.  ``star_components``
takes more steps a round but rewires the edges, so that none is multiplied and a hub's edges are never one task's.

For it, edges point from the larger node to the smaller one.  A large star hangs the larger neighbours of each node on the node's smallest
neighbour; a small star hangs a node and its smaller neighbours on the smallest of them.  No node gains neighbours that
it must hand on to others, so a hub's edges are never multiplied, and the number of rounds grows with the logarithm of long chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafpress.storage import materialize

#: The edges of a node with more of them stay where they are, and the node's smallest neighbour is sent to them.
HUB = 200_000


def _smallest(edges: DataFrame) -> DataFrame:
    """(node, least, n): of each node that has smaller neighbours, the smallest and their number."""
    return edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least"), F.count("*").alias("n"))


def _looked_up(edges: DataFrame, end: str, least: DataFrame, hub: int) -> DataFrame:
    """Add ``least`` of the node at ``end``, or null.

    Edges of hubs, of which there are at most edges / ``hub``, are joined without being dealt by their hub.
    """
    table = least.select(F.col("node").alias(end), "least")
    hubs = edges.groupBy(end).agg(F.count("*").alias("n")).where(F.col("n") > hub).select(end)
    if not hubs.limit(1).count():
        return edges.join(table, end, "left")
    hubs = materialize(hubs, "hubs")
    few = F.broadcast(hubs)
    return edges.join(few, end, "left_anti").join(table, end, "left").unionByName(edges.join(F.broadcast(hubs.join(table, end, "left")), end))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Each round takes the smallest label among a node's neighbours and then follows the label's own label, so the
    number of rounds grows with the logarithm of long chains; labels only fall, so it ends.  Labels are written after each round: lineage
    stays short and lost executors cost one round.  Edges with a null end are ignored.  Nothing but one count per round
    reaches the driver.
    """
    both = edges.where(f"{a} is not null and {b} is not null and {a} <> {b}").selectExpr(f"{a} as node", f"{b} as other")
    both = materialize(both.union(both.selectExpr("other", "node")).distinct(), "edges")
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("o")).selectExpr("node", "least(node, o) as component"), "labels")
    while True:
        near = both.join(labels.selectExpr("node as other", "component as c"), "other").groupBy("node").agg(F.min("c").alias("c"))
        lower = labels.join(near, "node").selectExpr("node", "component as was", "least(component, c) as c")
        jumped = lower.join(labels.selectExpr("node as c", "component as cc"), "c").selectExpr("node", "least(c, cc) as component", "was")
        new = materialize(jumped, "labels")
        changed = new.where("component <> was").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels


def star_components(edges: DataFrame, a: str = "a", b: str = "b", hub: int = HUB) -> DataFrame:
    """(node, component) for every node of ``edges`` that an edge joins to another; the component is its smallest node.

    Edges with a null end and from a node to itself are ignored; repeated ones count once; an empty table gives no rows.  Edges are written
    after each star: lineage stays short and lost executors cost one star.  Nothing but whether rows are left reaches the driver.
    """
    pairs = edges.where(f"{a} is not null and {b} is not null and {a} <> {b}")
    edges = materialize(pairs.selectExpr(f"greatest({a}, {b}) as x", f"least({a}, {b}) as y").distinct(), "edges")
    while True:
        least = materialize(_smallest(edges), "least")
        # Each node has one smaller neighbour, which has none: a star for each component
        if not least.where("n > 1").limit(1).count() and not edges.join(least.selectExpr("node as y"), "y", "left_semi").limit(1).count():
            return edges.selectExpr("x as node", "y as component").unionByName(edges.selectExpr("y as node", "y as component").distinct())
        large = materialize(_looked_up(edges, "y", least, hub).selectExpr("x", "coalesce(least, y) as y").distinct(), "large")
        found = _looked_up(large, "x", _smallest(large), hub)
        small = found.selectExpr("x", "least as y").unionByName(found.where("y <> least").selectExpr("y as x", "least as y"))
        edges = materialize(small.distinct(), "small")
