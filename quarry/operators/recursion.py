"""Recursive queries (inventory F11) by path doubling.

A recursive CTE that walks one edge a step needs as many steps as its deepest
path, and on Spark each step is a job. Here round ``k`` knows the reachable nodes
within ``2**k - 1`` edges and the node pairs that are ``2**k`` edges apart: joining
the two doubles the distance, and joining the pairs with themselves doubles their
length. A chain of 2,000 levels takes 11 rounds.

Only the nodes of the last round's *delta* (new, or reached by a shorter path) are
joined, and the running result is one written table, merged with the delta by a
grouped minimum. In a forest a node has one ancestor at each distance, so the pairs
never outnumber the edges. In a general graph they can grow towards the pairs of the
transitive closure; ``method="steps"`` then walks edge by edge with the same delta.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import written_table


def reachable(seeds: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst", node: str = "node",
              depth: str = "depth", method: str = "doubling") -> DataFrame:
    """``node, depth`` of every node reachable from ``seeds`` (column ``node``):
    ``depth`` is the fewest edges, 0 for a seed. Set semantics (``UNION``): cycles
    end, repeated edges and seeds count once. NULL nodes take no part. Key columns
    may be structs, for composite keys.
    """
    if method not in ("doubling", "steps"):
        raise ValueError(method)
    pairs = edges.select(F.col(src).alias("x"), F.col(dst).alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull()).distinct()
    pairs = written_table(pairs.withColumn("d", F.lit(1).cast("bigint")), "pairs")
    known = written_table(seeds.select(F.col(node).alias("n"), F.lit(0).cast("bigint").alias("d")).where(F.col("n").isNotNull()).distinct(), "known")
    delta, length = known, 1
    while True:
        # doubling: every node of the result lies less than ``length`` edges deep, and all of them may be extended
        step = (known if method == "doubling" else delta).select(F.col("n").alias("x"), F.col("d").alias("d0"))
        reached = pairs.join(step, "x").select(F.col("y").alias("n"), (F.col("d0") + F.col("d")).alias("d"))
        merged = (known.withColumn("old", F.col("d")).unionByName(reached.withColumn("old", F.lit(None).cast("bigint")))
                  .groupBy("n").agg(F.min("d").alias("d"), F.min("old").alias("old")))
        merged = written_table(merged, "merged")
        delta = merged.where(F.col("old").isNull() | (F.col("d") < F.col("old"))).select("n", "d")
        if delta.isEmpty():
            return merged.select(F.col("n").alias(node), F.col("d").alias(depth))
        known = merged.select("n", "d")
        if method == "doubling":
            length *= 2
            ahead = pairs.select(F.col("x").alias("y"), F.col("y").alias("z"))
            pairs = written_table(pairs.join(ahead, "y").select("x", F.col("z").alias("y")).distinct()
                                  .withColumn("d", F.lit(length).cast("bigint")), "pairs")


def roots(nodes: DataFrame, node: str = "node", parent: str = "parent", root: str = "root", depth: str = "depth") -> DataFrame:
    """``node, root, depth`` of a forest given as ``node`` and its ``parent`` (NULL
    or absent from ``node``: a root), by pointer doubling: each node's pointer
    jumps to its pointer's pointer, so ``log2(depth)`` joins end it. A node on, or
    below, a cycle has no root: NULL ``root`` and ``depth``. ``node`` must be unique.
    """
    known = nodes.select(F.col(node).alias("n"), F.col(parent).alias("p")).where(F.col("n").isNotNull())
    present = known.select(F.col("n").alias("m"))
    up = known.join(present, F.col("p") == F.col("m"), "left").select(
        "n", F.col("m").alias("up"), F.col("m").isNotNull().cast("bigint").alias("d"))
    state = written_table(up.select("n", F.coalesce("up", "n").alias("up"), "d", F.col("up").isNull().alias("done")), "pointers")
    left = state.where(~F.col("done")).count()
    while left:
        ahead = state.select(F.col("n").alias("m"), F.col("up").alias("far"), F.col("d").alias("more"), F.col("done").alias("there"))
        state = written_table(state.join(ahead, F.col("up") == F.col("m")).select(
            "n", F.when(F.col("done"), F.col("up")).otherwise(F.col("far")).alias("up"),
            F.when(F.col("done"), F.col("d")).otherwise(F.col("d") + F.col("more")).alias("d"), (F.col("done") | F.col("there")).alias("done")),
            "pointers")
        before, left = left, state.where(~F.col("done")).count()
        if left == before:
            break  # every round ends at least one path that has a root: the rest leads into cycles
    return state.select(F.col("n").alias(node), F.when(F.col("done"), F.col("up")).alias(root), F.when(F.col("done"), F.col("d")).alias(depth))
