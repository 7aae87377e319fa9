"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 6).

A document's size is its number of words. Sources, in code-point order with null
last, get the weights in turn and share ``total_percent`` of all words; a target
stops at ``max_repeat`` times the source's words and the excess is shared again by
weight until no target is above that.

Words are dealt in blocks of ``block_words``. Blocks go one by one to the source
with the highest quotient ``target / (2 * blocks + 1)``, and a source's blocks in
the same way to its shards (documents by seeded hash of id and text) by their words: integer
quotas. Quotas come from the equivalent divisor, not from counting blocks out. A
shard whose quota is above ``max_repeat`` times its words is held there, and the
source's other words are dealt again among its other shards, the last block in part
where it must be, so a source falls short of its blocks only where all of its shards
are held. A shard lays its documents end to end in seeded order and takes its quota's blocks
from the front, starting again at the end; so a document is taken whole, in part
or repeated, at most ``max_repeat`` times.

The driver sees nothing; one task sees one row per source, and one per shard of a
source. A source of any share of the rows is spread over its shards.

Defined cases: null text: size 0, taken 0. Null source: a source of its own, last.
Documents are dealt by a hash of id, size and text, so rows that share an id, null too, are spread;
equal rows are documents of their own in one shard. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_SHARD = 200_000
LEAST_SHARDS = 64


def targets(sizes: Sequence[int], weights: Sequence[int], total: Fraction, max_repeat: int) -> list[Fraction]:
    """Shares of ``total`` by weight, none above ``max_repeat`` times its size."""
    out = [Fraction(0)] * len(sizes)
    free, left = list(range(len(sizes))), Fraction(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > max_repeat * sizes[i]]
        if not over:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = Fraction(max_repeat * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients ``votes / (2 s + 1)``, ties to the earlier entry.

    A divisor that leaves no more than ``seats`` is found by halving; the few seats
    left over (ties and rounding) are given out one by one.
    """
    votes = np.asarray(votes, float)
    if seats <= 0 or not votes.sum():
        return np.zeros(len(votes), np.int64)
    given = lambda divisor: np.floor(votes / divisor + 0.5).astype(np.int64)
    high = votes.sum() / seats
    while given(high).sum() > seats:
        high *= 2
    low = high / 2
    while given(low).sum() <= seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if given(middle).sum() > seats else (low, middle)
    out = given(high)
    queue = [(-v / (2 * s + 1), i) for i, (v, s) in enumerate(zip(votes, out)) if v > 0]
    heapq.heapify(queue)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(queue)
        out[i] += 1
        heapq.heappush(queue, (-votes[i] / (2 * out[i] + 1), i))
    return out


def shard_words(sizes: np.ndarray, blocks: int, block_words: int, max_repeat: int) -> np.ndarray:
    """Words each shard gives: ``blocks`` blocks by size, none above ``max_repeat`` times its size, the excess dealt again."""
    sizes = np.asarray(sizes, np.int64)
    most, out = max_repeat * sizes, np.zeros(len(sizes), np.int64)
    left, free = min(blocks * block_words, int(most.sum())), np.flatnonzero(sizes)
    while left:
        quota = sainte_lague(sizes[free], left // block_words)
        over = quota * block_words > most[free]
        if not over.any():
            out[free] = quota * block_words
            part = left % block_words  # to the shards next in turn that have room
            for k in free[np.argsort(-sizes[free] / (2 * quota + 1), kind="stable")] if part else ():
                more = min(part, int(most[k] - out[k]))
                out[k] += more
                part -= more
            break
        out[free[over]] = most[free[over]]
        left -= int(most[free[over]].sum())
        free = free[~over]
    return out


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                weights: Sequence[int] = (3, 1, 2), total_percent: int = 150, max_repeat: int = 2,
                block_words: int = 16, seed: int = 11) -> DataFrame:
    """``doc_id, source, size, source_size, target, shard, shard_words, taken`` per row of ``docs``."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = docs.count()
    shards = max(LEAST_SHARDS, -(-rows // ROWS_PER_SHARD))
    sized = sized.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "size", "text_hash")).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(~seed), "doc_id", "size", "text_hash"), F.lit(shards)))
    per_shard = sized.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    per_source = per_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))

    def by_source(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [None if x is None or x != x else x for x in pdf["source"]]
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
        sizes = [int(pdf["source_size"].iloc[i]) for i in order]
        total = Fraction(sum(sizes) * total_percent, 100)
        goal = targets(sizes, [weights[k % len(weights)] for k in range(len(order))], total, max_repeat)
        blocks = sainte_lague(np.array([float(x) for x in goal]), round(total / block_words))
        return pd.DataFrame({"source": pd.Series([names[i] for i in order], dtype=object), "source_size": sizes,
                             "target": [float(x) for x in goal], "blocks": blocks})

    def by_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", ignore_index=True)
        pdf["shard_words"] = shard_words(pdf["shard_size"].to_numpy(), int(pdf["blocks"].iloc[0]), block_words, max_repeat)
        return pdf.drop(columns="blocks")

    plan = (per_source.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(by_source, "source string, source_size long, target double, blocks long")
            .withColumnRenamed("source", "name"))
    quota = (per_shard.join(plan, F.col("source").eqNullSafe(F.col("name")))
             .select("source", "shard", "shard_size", "source_size", "target", "blocks")
             .groupBy("source").applyInPandas(by_shard, "source string, shard long, shard_size long, source_size long, target double, shard_words long")
             .withColumnsRenamed({"source": "name", "shard": "part"}))
    line = Window.partitionBy("source", "shard").orderBy("order", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    laid = (sized.withColumn("before", F.sum("size").over(line) - F.col("size"))
            .join(quota, F.col("source").eqNullSafe(F.col("name")) & (F.col("shard") == F.col("part"))))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("shard_words") / F.col("shard_size"))).otherwise(0)
    rest = F.col("shard_words") - rounds * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return laid.select("doc_id", "source", "size", "source_size", "target", "shard", "shard_words",
                       (rounds * F.col("size") + part).cast("long").alias("taken"))
