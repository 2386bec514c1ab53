"""Connected components of a graph given as pairs of longs.

Alternates two steps: every node links its larger neighbours to its smallest one,
then every node links its smaller neighbours to the smallest of them. Each keeps
the components and the number of edges does not grow; the result is a star around
the smallest node. Each round is written to the shared folder. Minima are taken by
partial aggregation, so a hub's edges are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
        .filter("a <> b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), "m")
    return moved.union(least.select("u", "m")).toDF("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes that have an edge; the root is the smallest node."""
    # Each step reads the edges several times.
    edges = store(edges.toDF("a", "b").filter("a <> b"), "edges")
    before = None
    while True:
        edges = store(_small_star(_large_star(edges)), "star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.toDF("node", "root").union(roots)
