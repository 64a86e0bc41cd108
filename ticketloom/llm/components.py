"""Connected components of an edge table, by alternating star contractions.

Kiveris et al. 2014: every step rewires the edges of each node to its smallest neighbour. Minima
are partial aggregates and the rewiring is an equi-join that may be split where skewed, so a node
with very many edges never becomes one task's work. Every step is written as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come in with a > b and leave so."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(smallest.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges `a`, `b`; the root is the smallest node reachable.

    Self-loops and null ends count as no edge; repeated edges count once; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialise(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = materialise(_large_star(edges), "large-star")
        edges = materialise(_small_star(edges), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    # a star forest: every node but a root has one edge, to its root
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
