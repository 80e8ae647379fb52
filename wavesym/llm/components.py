"""Connected components of a graph that no machine holds, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavesym.llm.store import Work


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()  # one row


def components(edges: DataFrame, work: Work) -> DataFrame:
    """node, component (smallest node reachable) for every node of the edges (a, b).

    Each round joins the edges with the smallest neighbour of their nodes; neighbours are never gathered, so a
    node that a third of all edges meet is as good as any other. Rounds grow with the logarithm of the size.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = work.table(edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))  # node a, neighbour b
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large star: greater neighbours of a move to the least
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # small star: smaller neighbours of b, and b itself, move to the least
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b")
        pairs = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(down.select(F.col("m").alias("a"), "b"))
        new = work.table(pairs.filter("a <> b").distinct(), "edges")
        work.drop(edges)
        edges, before, state = new, state, _state(new)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return work.table(edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots), "components")
