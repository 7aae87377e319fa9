"""Exact top-k by inner product with Fagin's threshold algorithm (operator 4).

Components become integers, ``floor(scale * x)``. Candidates are dealt by a hash of id
and vector (and of the copy, where rows are equal) into blocks of bounded size, which
stand; the queries pass each block in a stream, so a candidate is sent once and a
query once a block. In a block every dimension has its list of candidates sorted by component. A query reads the
lists from their better ends, deeper and deeper; what it meets is scored in full by
random access, and it stops as soon as the bound, the score that a vector at the
present depth of every list would have, is below the kth best score (not at equality:
an unseen vector could tie with a smaller id). The blocks' results are merged by
rank. Nothing is dropped: blocks only divide the work, and the bound makes each
block's answer exact.

A query's own row is no candidate; another row of the same id is. Blocks return one
result more than asked for, and one row of the query's id and its own score is taken
out at the end, which is the same.

Defined cases: vectors null, or holding null or non-finite components, take no part.
Vectors are compared within equal length only (an empty one scores 0). Ties go to the
smaller id, then stay in no order that shows. A query row that occurs several times
returns its results as many times. Rows with a null id take no part. Extra columns
are ignored. Scores beyond 64 bits are not supported.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 32_768  # candidates that stand in one task, of 64 components; fewer longer ones
QUERY_BLOCK = 256         # queries answered at a time
FIRST_DEPTH = 16


def best_in_block(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best candidates, ties to smaller ids; ``lists[d]`` has positions by ascending component."""
    n = len(ids)
    dims = np.flatnonzero(query)
    seen = np.zeros(n, bool)
    top, score = np.empty(0, np.int64), np.empty(0, vectors.dtype)
    at, depth = 0, FIRST_DEPTH
    rising = query[dims] < 0
    while True:
        depth = min(depth, n)
        if len(dims):
            met = np.concatenate([lists[dims[rising], at:depth].ravel(), lists[dims[~rising], n - depth:n - at].ravel()])
            fresh = np.zeros(n, bool)
            fresh[met] = True
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
        else:
            new, depth = np.arange(n), n
        top, score = np.concatenate([top, new]), np.concatenate([score, vectors[new] @ query])
        if len(top) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            keep = score >= least
            top, score = top[keep], score[keep]
            best = np.lexsort((ids[top], -score))[:k]
            top, score = top[best], score[best]
        if depth == n:
            break
        if len(top) >= k:
            edge = np.where(rising, lists[dims, depth], lists[dims, n - 1 - depth])
            if query[dims] @ vectors[edge, dims] < score.min():
                break
        at, depth = depth, depth * 2
    best = np.lexsort((ids[top], -score))[:k]
    return top[best], score[best]


class Block:
    """The standing candidates of one block, by length of vector, and its answers."""

    def __init__(self, ids: list[int], vectors: list[np.ndarray]):
        self.parts = {}
        sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            own = np.array([vectors[i] for i in at], np.int64).reshape(len(at), dim)
            self.parts[dim] = (np.array(ids, np.int64)[at], own, np.argsort(own, axis=0, kind="stable").T.copy())

    def answers(self, queries: list[tuple[int, int, np.ndarray]], k: int) -> Iterator[tuple[int, int, int, int]]:
        """``(query id, hash, vector id, score)`` of the k best for each ``(id, hash, vector)``."""
        for dim, (ids, own, lists) in self.parts.items():
            some = [q for q in queries if len(q[2]) == dim]
            if not some:
                continue
            ask = np.array([q[2] for q in some], np.int64).reshape(len(some), dim)
            largest = dim * float(np.abs(own).max(initial=0)) * float(np.abs(ask).max(initial=0))
            kind = np.float64 if largest < 2 ** 53 else np.int64  # exact in both
            vectors = own.astype(kind)
            for (name, mark, _), query in zip(some, ask.astype(kind)):
                at, score = best_in_block(query, vectors, ids, lists, k)
                yield from zip(itertools.repeat(name), itertools.repeat(mark), ids[at].tolist(), score.astype(np.int64).tolist())


def _search(k: int):
    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("block", "asks", "id", "hash")),
                           (np.asarray(v, np.int64) for v in batch.column("v").to_pylist()))

    def found(batches):
        for _, group in itertools.groupby(rows(batches), key=itemgetter(0)):
            standing, first = ([], []), None
            for row in group:  # candidates come first
                if row[1]:
                    first = row
                    break
                standing[0].append(row[2])
                standing[1].append(row[4])
            if first is None or not standing[0]:
                for _ in group:
                    pass
                continue
            block = Block(*standing)
            queries = ((r[2], r[3], r[4]) for r in itertools.chain([first], group))
            while some := list(itertools.islice(queries, QUERY_BLOCK)):
                yield list(block.answers(some, k))

    def run(batches):
        for part in found(batches):
            if part:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part)], ["query_id", "hash", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query row's k best other rows."""
    number = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
            .select(F.col(id_col).cast("long").alias("id"), number.alias("v"), is_query.alias("asks"))
            .withColumn("dim", F.size("v")))
    queries = rows.where("asks").groupBy("id", "v", "dim").agg(F.count(F.lit(1)).alias("times"))
    # of equal candidates no query returns more than k, besides its own row: their number is bounded, and so is a block's
    once = rows.groupBy("id", "v", "dim").agg(F.count(F.lit(1)).alias("times"))
    candidates = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k + 1).cast("long")))))
    n, components = rows.agg(F.count(F.lit(1)), F.sum("dim")).first()
    blocks = max(1, -(-n // CANDIDATE_BLOCK), -(-(components or 0) // (64 * CANDIDATE_BLOCK)))
    number = F.pmod(F.xxhash64("id", "v", "copy"), F.lit(blocks))
    standing = candidates.select(number.alias("block"), F.lit(0).alias("asks"), "id", "v", "dim", F.lit(0).cast("long").alias("hash"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    passing = queries.select(every.alias("block"), F.lit(1), "id", "v", "dim", F.xxhash64("v"))
    found = (standing.union(passing).repartition("block").sortWithinPartitions("block", "asks")
             .mapInArrow(_search(k + 1), "query_id long, hash long, vec_id long, score long"))
    line = Window.partitionBy("query_id", "hash").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("r", F.row_number().over(line)).where(F.col("r") <= k + 1)
    own = queries.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("hash"), "times",
                         F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("self"))
    best = best.join(own, ["query_id", "hash"])
    mine = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("self")), F.col("r"))).over(
        Window.partitionBy("query_id", "hash"))
    best = (best.withColumn("mine", mine).where(F.col("mine").isNull() | (F.col("r") != F.col("mine")))
            .withColumn("rank", (F.col("r") - F.when(F.col("mine") < F.col("r"), 1).otherwise(0)).cast("int"))
            .where(F.col("rank") <= k))
    return (best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("query_id", "rank", "vec_id", "score"))
