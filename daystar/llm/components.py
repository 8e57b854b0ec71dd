"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.llm.tables import stored


def _large_star(edges):
    """Every neighbour above a node is tied to the least node around that node."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (
        pairs.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges):
    """A node and its lower neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a")
    return (
        lower.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(edges, a="a", b="b"):
    """(node, component) of every node of `edges` that is not the least of its component.

    Edges are undirected, of any type that has an order; repeated edges, loops and edges
    with a null end count nothing, and no edges give no rows. The least node of a
    component names it: callers take a node without a row as its own component.

    Both kinds of star only ever need the least neighbour of a node, an aggregate that is
    added up before the shuffle, and a join that the adaptive plan splits where a node has
    very many edges. Rounds grow with the logarithm of the longest path, and each writes
    its edges, so no lineage builds up.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    now = stored(
        edges.where(F.col(a) != F.col(b)).select(high.alias("a"), low.alias("b")).distinct(),
        "edges",
    )
    before = None
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
