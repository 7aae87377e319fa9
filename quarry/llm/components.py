"""Connected components of a link table by alternating stars (union-find as joins).

Each round first hangs every node's larger neighbours on its smallest one, then
hangs each node and its smaller neighbours on their smallest; the table ends as
one star per component. Every step is a partial ``min`` plus a join that AQE can
split, so a component of any size is never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import materialize, remove


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # eqNullSafe keeps an exchange above the aggregate's side, so that a hot node's rows can be split
    large = (both.join(_smallest(both), F.col("u").eqNullSafe(F.col("k")))
             .where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
             .where("u <> v").distinct())
    large = materialize(large, "large_star")
    small = large.join(_smallest(large), F.col("u").eqNullSafe(F.col("k")))
    # each node hangs on m, and so does each of its smaller neighbours
    return (small.select(F.explode(F.array(F.struct(F.col("u").alias("b"), F.col("m").alias("a")),
                                           F.struct(F.col("v").alias("b"), F.col("m").alias("a")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node is both a root (``a``) and a leaf (``b``), or a leaf of two."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(0).alias("leaf")), F.struct(F.col("b").alias("n"), F.lit(1).alias("leaf")))).alias("e"))
    seen = ends.groupBy(F.col("e.n").alias("n")).agg(F.min("e.leaf").alias("low"), F.sum("e.leaf").alias("leaves"))
    return seen.where("leaves > 1 or (leaves = 1 and low = 0)").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; component is its smallest node.

    ``links`` holds long columns ``a`` and ``b`` in any direction; loops and
    repeats are ignored. Runs until the links are stars (no round limit): as
    ``a`` is the smaller end of each, a star's root is its smallest node.
    """
    edges = (links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
             .where("a <> b").distinct())
    edges = materialize(edges, "edges")
    while not _are_stars(edges):
        last, edges = edges, materialize(_round(edges), "edges")
        remove(last)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
