"""Connected components of an edge table, without gathering any of it on the driver.

Randomised contraction: in each round every node moves to the neighbour, or itself, that comes first in an order drawn
anew by hash; edges are rewritten to where their ends went, loops and repeats drop out, and the graph shrinks by a
constant factor in expectation, whatever its shape. A round is one aggregate, which combines before its shuffle, and
two equi-joins against a table with one row a node, so a hub costs no more than its edges. It ends when no edge is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import materialize, release


def _contract(edges: DataFrame, n: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """moved (node, root) and the edges between different roots. edges: a < b, no repeats; n: how many."""
    order = lambda c: F.xxhash64(F.lit(turn), c)
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    first = both.groupBy("a").agg(F.min(F.struct(order(F.col("b")).alias("at"), F.col("b").alias("id"))).alias("first"))
    own = F.struct(order(F.col("a")).alias("at"), F.col("a").alias("id"))
    moved = materialize(first.select(F.col("a").alias("node"), F.least(own, "first")["id"].alias("root")), "moved", n)
    one, two = (moved.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    placed = edges.join(one, "a").join(two, "b").filter("root_a != root_b")
    left = placed.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct()
    return moved, materialize(left, "edges", n)


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of edges (a long, b long). The result is a stored table; a node that has loops only is left out."""
    n = edges.count()
    left = materialize(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", n)
    rounds: list[DataFrame] = []
    while not rounds or (n := left.count()):
        moved, after = _contract(left, n, len(rounds))
        release(left)
        rounds.append(moved)
        left = after
    release(left)
    roots, nodes = rounds[0], rounds[0].count()
    for moved in rounds[1:]:  # where each node's root went further
        onward = moved.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = roots.join(onward, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    roots = materialize(roots, "roots", nodes)
    release(*rounds)
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    out = materialize(roots.join(least, "root").select("node", "component"), "components", nodes)
    release(roots)
    return out
