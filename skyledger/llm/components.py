"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import written


def _nearest(edges: DataFrame) -> DataFrame:
    """``u, v, m``: each directed edge with the smallest node in the closed neighbourhood of u.

    The minimum is an aggregate that combines map-side. It is written, as Spark splits the edges
    of a node with very many only where they join a table and no aggregate of the same stage.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(written(least, "nearest"), "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _nearest(_both_ways(edges)).filter("v > u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _nearest(edges)  # every edge points from the larger to the smaller node
    moved = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that point to two nodes, or point to one and are pointed to. None: all are stars."""
    outward = edges.select(F.col("u").alias("node"), F.lit(1).alias("to"), F.lit(0).alias("by"))
    inward = edges.select(F.col("v").alias("node"), F.lit(0).alias("to"), F.lit(1).alias("by"))
    roles = outward.unionByName(inward).groupBy("node")
    roles = roles.agg(F.sum("to").alias("to"), F.max("by").alias("by"))
    return roles.filter("to > 1 or (to > 0 and by > 0)")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; the root is the component's smallest node.

    Links are undirected, may repeat and may join a node with itself (such links are ignored);
    null ends are ignored. The number of rounds grows with the logarithm of the longest path. All
    state is in written tables; the driver sees one flag a round.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
    )
    edges = written(edges, "links")
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        if _unsettled(edges).isEmpty():
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
