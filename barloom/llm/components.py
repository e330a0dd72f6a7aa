"""Connected components of a link table by randomised contraction.

In each round every node points at the neighbour (or itself) that is least under a fresh random
order, and the links are redrawn between the nodes pointed at. The expected number of nodes that
are left shrinks by a constant factor each round, whatever the shape of the graph, so long chains
need no more than a logarithmic number of rounds (Boegeholz, Brand and Todor, "In-database
connected component analysis", 2020). No node's links are gathered in one place: the pick is an
aggregate with a map-side half, and the redrawing is two equi-joins, whose hot side Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """Links (a long, b long) to (node, root): equal roots for nodes that are connected.

    Only nodes with a link to another node are returned. Nulls, loops and repeated links are
    ignored; no links give no rows. Every round is a written table, so a lost executor costs that
    round's tasks only.
    """
    edges = keep(links.where("a <> b").select("a", "b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        salt = F.lit(len(rounds))
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = ends.unionByName(edges.select("a", F.col("a").alias("b")))
        ends = ends.unionByName(edges.select("b", F.col("b").alias("a")))
        pointers = keep(
            ends.groupBy(F.col("a").alias("node")).agg(F.min_by("b", F.xxhash64("b", salt)).alias("root")), "pointers"
        )
        rounds.append(pointers)
        at_a = pointers.select(F.col("node").alias("a"), F.col("root").alias("to_a"))
        at_b = pointers.select(F.col("node").alias("b"), F.col("root").alias("to_b"))
        moved = edges.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        edges = keep(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links"
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1]
    for pointers in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = pointers.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
        found = keep(found, "roots")
    return found
