"""Connected components of an edge table by contraction, wholly in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges(a, b)``; both longs.

    The component is its smallest vertex. Each round maps a vertex to the
    smallest of itself and its neighbours, follows these pointers to their
    roots by doubling, and replaces the edges by those between roots. Rounds
    and doublings are logarithmic; every step is a table in the shared folder,
    and each join has two plain sides, so that a hub with very many neighbours
    may be split. Loops are allowed and give a component of their own.
    """
    found: DataFrame | None = None
    left = edges.select("a", "b")
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        roots = _jumped(stored(near, "cc-near"))
        found = roots if found is None else stored(_through(found, roots), "cc-found")
        a = roots.select(F.col("vertex").alias("a"), F.col("root").alias("root_a"))
        b = roots.select(F.col("vertex").alias("b"), F.col("root").alias("root_b"))
        met = left.join(a, "a").select("b", "root_a").join(b, "b").where("root_a <> root_b")
        left = stored(met.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "cc-left")
        if left.isEmpty():
            return found.select("vertex", F.col("root").alias("component"))


def _through(found: DataFrame, roots: DataFrame) -> DataFrame:
    """``found`` with each root replaced by that root's own."""
    after = roots.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
    return found.join(after, "root", "left").select("vertex", F.coalesce("next", "root").alias("root"))


def _jumped(roots: DataFrame) -> DataFrame:
    while True:
        after = roots.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
        jumped = stored(roots.join(after, "root").select("vertex", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "cc-jump")
        moved = not jumped.where("moved").isEmpty()
        roots = jumped.select("vertex", "root")
        if not moved:
            return roots
