"""Connected components by alternating large and small stars.

Every round is two group minima and two joins over the edges, written to the shared
folder, so no component is ever gathered in one place and a lost executor costs one
round. Edges shrink to one per node; the number of rounds grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("m")), "least")
    return (
        both.join(least, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links between long ids to ``(node, root)``: for each node that has a
    link, the smallest node it can reach, when that is another one. Links of a node with
    itself and links given twice change nothing; links with a null are left out."""
    current = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        current = materialise(_small_star(materialise(_large_star(current), "edges")), "edges")
        previous, state = state, _state(current)
        if state == previous:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
