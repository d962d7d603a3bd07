"""Connected components of a graph given as links, by alternating large and small stars.

Each round replaces links by links to the smallest neighbour, computed as a minimum (so a node
with a third of all links is pre-aggregated before the shuffle) and joined back (a join that
adaptive execution can split). Labels never reach the driver; only a count of links does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` (the smallest node of its component), for linked nodes.

    ``links`` has columns ``a`` and ``b`` of one orderable type. Links with a null end and links
    from a node to itself are left out, repeated ones count once, and without links the result
    is empty. A node without links to others does not occur.
    """
    edges = written(_down(links), "links")
    before = None
    while True:
        stars = _small_star(written(_large_star(edges), "links"))
        edges = written(stars, "links")
        # A fixed point is a set of stars: each node points to its smallest and to nothing else.
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("x"),
        ).first()
        if before == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        before = state


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return (
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = edges.union(edges.select("b", "a"))
    smallest = both.groupBy("a").agg(F.min("b").alias("m"))
    smallest = smallest.select("a", F.least("a", "m").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return _down(larger.join(smallest, "a").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are linked to the smallest one."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.union(smallest.select("a", "m")))
