"""Connected components by alternating large-star and small-star steps.

An edge (a, b) has a > b; a node's parent is its least neighbour below it. A large-star hands a
to the parent of b (to b where b has none), a small-star hands b and a to the parent of a: each
is a join of the edges with the parents. The nodes' degrees tell when all edges are stars, and
which nodes would fill one task of such a join. There are at most HOT of these on each side, by
count, so their parents are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: A node is hot with more than 1 / HOT of all edges on one side, and more than LEAST_HOT.
HOT, LEAST_HOT = 1000, 1024


def _nodes(edges: DataFrame) -> DataFrame:
    """(node, parent, up, down): a node's parent, its edges to lesser and to greater nodes."""
    lower = F.struct(F.col("a").alias("node"), F.col("b").alias("parent"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    upper = F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("parent"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    return edges.select(F.inline(F.array(lower, upper))).groupBy("node").agg(F.min("parent").alias("parent"), F.sum("up").alias("up"), F.sum("down").alias("down"))


def _with_parents(edges: DataFrame, end: str, parents: DataFrame, hot: list[int]) -> DataFrame:
    """(a, b, parent) of each edge's node `end`, null where it has none."""
    parents = parents.select(F.col("node").alias(end), "parent")
    if not hot:
        return edges.join(parents, end, "left").select("a", "b", "parent")
    is_hot = F.col(end).isin(hot)
    cold = edges.where(~is_hot).join(parents, end, "left")
    few = F.broadcast(parents.where(is_hot))  # at most HOT rows
    return cold.select("a", "b", "parent").unionAll(edges.where(is_hot).join(few, end, "left").select("a", "b", "parent"))


def _large_star(edges: DataFrame, nodes: DataFrame, hot: list[int]) -> DataFrame:
    """Each node hands its greater neighbours to its parent (or keeps them)."""
    parents = nodes.where("parent IS NOT NULL")
    return _with_parents(edges, "b", parents, hot).select("a", F.coalesce("parent", "b").alias("b"))


def _small_star(edges: DataFrame, hot: list[int]) -> DataFrame:
    """Each node hands itself and its lesser neighbours to its parent."""
    parents = edges.groupBy("a").agg(F.min("b").alias("parent")).withColumnRenamed("a", "node")
    ends = F.array(F.struct(F.col("a"), F.col("parent").alias("b")), F.struct(F.col("b").alias("a"), F.col("parent").alias("b")))
    return _with_parents(edges, "a", parents, hot).select(F.inline(ends)).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; a component's name is its least node.

    `edges` has long columns a and b. Self-loops, repeats and nulls are dropped; no edges
    give an empty table. Every round writes its edges to the shared checkpoint folder.
    """
    edges = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    while True:
        nodes = _nodes(edges)
        # a forest of stars: a node with an edge downward has no other edge
        seen = nodes.agg(F.sum("up").alias("n"), F.max((F.col("up") > 0) & (F.col("up") + F.col("down") > 1)).alias("tangled"), F.max("up").alias("up"), F.max("down").alias("down")).first()
        if not seen["tangled"]:
            break
        limit, hot = max(LEAST_HOT, seen["n"] // HOT), []
        if max(seen["up"], seen["down"]) > limit:
            hot = nodes.where((F.col("up") > limit) | (F.col("down") > limit)).select("node", "up", "down").collect()
        edges = _large_star(edges, nodes, [r["node"] for r in hot if r["down"] > limit])
        edges = cut(_small_star(edges, [r["node"] for r in hot if r["up"] > limit]))
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("component")), F.struct(F.col("b").alias("node"), F.col("b").alias("component")))
    return edges.select(F.inline(ends)).distinct()
