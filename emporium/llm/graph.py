"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each round links every node to
the smallest node it can see, so the longest chain shrinks by a constant
factor and the result is a set of stars.  The edge list never reaches the
driver; a round is a partially aggregated minimum and a join, and its result
is written to the shared folder, which cuts the lineage.  In a large star the
minima of the few nodes with a large part of all edges are broadcast, so the
edges of a hub to larger nodes, as links to a group's smallest node are, never
meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.hot import join_counted
from emporium.session import materialise


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(a, b)`` edges of one ordered type → ``(node, root)``.

    ``root`` is the smallest node of the component, for every node that has
    an edge (a root is listed with itself).  Self-loops and repeated edges
    are allowed; an empty list gives no rows.
    """
    edges = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), name)
    state = _state(edges)
    while True:
        edges = materialise(_large_star(edges, state[0], name), name)
        edges = materialise(_small_star(edges), name)
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Count and an order-free digest of the edge set: equal when a round changed nothing."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h),
                           F.sum(h.cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, count: int, name: str) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
                        .select("u", F.least("u", "m").alias("m"), "n"), f"{name}-least")
    return join_counted(both.where("v > u"), least, ["u"], 2 * count) \
        .select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
