"""Skew-safe ordered scans: running sums, row numbers and LAG.

A window ``OVER (PARTITION BY k ORDER BY o)`` hash-partitions on ``k``; one hot
key then lands in one task, and a window with no PARTITION BY moves *every*
row into a single partition. Both are fine on a bounded input and wrong at
scale. The scan here keeps the ordinary window for ordinary keys and splits
only what is too big for one task:

1. **Count once.** One aggregate gives the count of every key holding more
   than ``rows_per_block`` rows, as a written table. Each such key is *hot*,
   whatever the size of the table; with no key the whole relation is one hot
   group. When nothing is hot the scan is the plain window and no further job
   runs.
2. **Split points.** A Bernoulli sample of the hot keys' rows (20 rows a
   sub-block at least) is gathered and sorted per key, on the executors, and
   every key's quantiles are kept: a written table of one row a hot key, with
   its split points as an array. That table is joined to the rows (broadcast
   while it has at most ``BROADCAST_POINTS`` points) and each row finds its
   sub-block by binary search in its key's array. No key and no split point
   passes through the driver or is held in the plan, so any number of hot
   keys gives the same plan. The sub-block is a deterministic function of the
   row, so a task recomputed after an executor loss puts rows in the same
   place. The points only balance the work: any sorted points give the same
   result.
3. **Scan.** One window ``PARTITION BY (keys, sub-block) ORDER BY order``:
   one hash exchange; a hot key spreads over its sub-blocks.
4. **Carry.** Totals and last row per (hot key, sub-block) are aggregated
   (partial aggregation; a table bounded by the number of sub-blocks), made
   exclusive prefixes by a window over that small table, and added back
   through a broadcast join of it.

ROWS semantics need a total order: ``order`` must make ``(keys, order)``
unique, otherwise the result depends on how ties are split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_bounded
from quarry.session import written_table

BLK = "_blk"
ROWS_PER_BLOCK = 2_000_000
MAX_BLOCKS = None        # sub-blocks of one key; no limit
SAMPLE_ROWS = 20_000
SAMPLES_PER_BLOCK = 20
BROADCAST_POINTS = 1_000_000


def _cols(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


@dataclass
class Blocks:
    """Split points of the hot keys: ``_hk_<key>`` columns and ``_points``, an ascending array of order structs."""

    keys: list[str]
    order: list[str]
    points: DataFrame
    most: int    # sub-blocks of one key at most
    total: int   # sub-blocks of all hot keys

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` with its sub-block and ``_is_split``, whether its key is split."""
        if self.keys:
            points = F.broadcast(self.points) if self.total <= BROADCAST_POINTS else self.points
            out = df.join(points, [F.col(k).eqNullSafe(F.col(f"_hk_{k}")) for k in self.keys], "left")
        else:  # one row: an uncorrelated scalar subquery, evaluated once
            out = df.withColumn("_points", self.points.select("_points").scalar())
        steps = [1 << b for b in range(self.most.bit_length(), -1, -1)]
        here = F.struct(*[F.col(c) for c in self.order])
        # how many points are at or before the row; structs compare field by field, NULLs first
        found = F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(
            F.get(F.col("_points"), n + step - 1) <= here, n + step).otherwise(n))
        return (out.withColumn(BLK, F.when(F.col("_points").isNull(), F.lit(0)).otherwise(found))
                .withColumn("_is_split", F.col("_points").isNotNull())
                .drop("_points", *[f"_hk_{k}" for k in self.keys]))


def plan_blocks(df: DataFrame, keys: list[str], order: list[str], rows_per_block: int = ROWS_PER_BLOCK,
                max_blocks: int | None = MAX_BLOCKS, sample_rows: int = SAMPLE_ROWS,
                seed: int = 17) -> Blocks | None:
    """Split points for :func:`ordered_scan`, or ``None`` when no key (or,
    without keys, the relation) needs splitting. The driver gets sums only."""
    hot_keys = [f"_hk_{k}" for k in keys]
    rows = df.select(*[F.col(k).alias(h) for k, h in zip(keys, hot_keys)], F.struct(*[F.col(c) for c in order]).alias("_at"))
    parts = F.ceil(F.col("_n") / rows_per_block).cast("int")
    hot = (rows.groupBy(*hot_keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_block)
           .withColumn("_parts", F.least(parts, F.lit(max_blocks)) if max_blocks else parts))
    hot_rows, total, most = hot.agg(F.sum("_n"), F.sum("_parts"), F.max("_parts")).first()
    if not hot_rows:
        return None
    fraction = min(1.0, max(sample_rows, SAMPLES_PER_BLOCK * total) / hot_rows)
    sample = rows.where(F.rand(seed) < fraction)
    if keys:
        small = broadcast_if_bounded(written_table(hot, "hot").select(*[F.col(h).alias(f"_j{h}") for h in hot_keys], "_parts"))
        sample = sample.join(small, [F.col(h).eqNullSafe(F.col(f"_j{h}")) for h in hot_keys])
    else:
        sample = sample.withColumn("_parts", F.lit(most))
    ordered = sample.groupBy(*hot_keys).agg(F.array_sort(F.collect_list("_at")).alias("_s"), F.max("_parts").alias("_parts"))
    at = F.transform(F.sequence(F.lit(1), F.greatest(F.col("_parts") - 1, F.lit(1))),
                     lambda j: F.get(F.col("_s"), F.floor(j * F.size("_s") / F.col("_parts")).cast("int")))
    points = written_table(ordered.where("_parts > 1").select(*hot_keys, F.array_distinct(at).alias("_points")), "points")
    return Blocks(keys, order, points, int(most), int(total))


def ordered_scan(df: DataFrame, keys: str | Sequence[str] | None,
                 order: str | Sequence[str], sums: Sequence[str] = (),
                 lag_cols: Sequence[str] = (), n_blocks: int | None = MAX_BLOCKS,
                 row_number: str | None = "_rn", rows_per_block: int = ROWS_PER_BLOCK,
                 sample_rows: int = SAMPLE_ROWS, planned: Blocks | None = None) -> DataFrame:
    """Running sums, row number and LAG(1) per key, skew-safe.

    Adds ``run_<c>`` for every column in ``sums`` (sum from the first row of
    the key up to and including the current row; NULL while only NULLs were
    seen), ``row_number`` (1-based position within the key) and ``prev_<c>``
    for every column in ``lag_cols`` (value on the previous row of the same
    key, NULL on the first). ``keys`` may be empty: the scan then runs over
    the whole relation, in one window partition only while the input is
    within ``rows_per_block`` rows. ``n_blocks`` caps the sub-blocks of one key;
    ``planned`` takes split points already made for ``df``.
    """
    keys, order = _cols(keys), _cols(order)
    sums, lag_cols = list(sums), list(lag_cols)
    planned = planned or plan_blocks(df, keys, order, rows_per_block, n_blocks, sample_rows)
    blocked = planned.place(df) if planned else df.withColumn(BLK, F.lit(0))

    ordering = [F.col(c).asc_nulls_first() for c in order]
    w = Window.partitionBy(*keys, BLK).orderBy(*ordering)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocked
    for c in sums:
        local = local.withColumn(f"_lrun_{c}", F.sum(c).over(w_run))
    local = local.withColumn("_lrn", F.row_number().over(w))
    for c in lag_cols:
        local = local.withColumn(f"_llag_{c}", F.lag(c, 1).over(w))
    # the same types whether or not anything is split
    run_type = {c: local.schema[f"_lrun_{c}"].dataType for c in sums}
    local = local.withColumn("_lrn", F.col("_lrn").cast("bigint"))

    if planned is None:
        # nothing is split: the window alone is the answer
        out = local
        for c in sums:
            out = out.withColumnRenamed(f"_lrun_{c}", f"run_{c}")
        if row_number:
            out = out.withColumn(row_number, F.col("_lrn"))
        for c in lag_cols:
            out = out.withColumnRenamed(f"_llag_{c}", f"prev_{c}")
        return out.drop(BLK, "_lrn")

    # Totals and last row per (split key, sub-block): rows of split keys only,
    # partially aggregated, so the exchange carries at most one row per
    # (split key, sub-block) and task.
    order_struct = F.struct(*[F.col(c) for c in order])
    per_bk = blocked.where("_is_split").groupBy(*keys, BLK).agg(
        *[F.sum(c).alias(f"t_{c}") for c in sums],
        F.count(F.lit(1)).alias("t_n"),
        *([F.max_by(F.struct(*[F.col(c).alias(c) for c in lag_cols]), order_struct).alias("_lv")]
          if lag_cols else []))
    sw = Window.partitionBy(*keys).orderBy(BLK)
    before = sw.rowsBetween(Window.unboundedPreceding, -1)
    carries = per_bk
    for c in sums:
        carries = carries.withColumn(f"c_{c}", F.sum(f"t_{c}").over(before))
    carries = carries.withColumn("c_n", F.sum("t_n").over(before))
    for c in lag_cols:
        carries = carries.withColumn(f"p_{c}", F.lag(F.col("_lv")[c], 1).over(sw))
    carries = carries.select(*[F.col(k).alias(f"_ck_{k}") for k in keys], F.col(BLK).alias("_cblk"),
                             *[f"c_{c}" for c in sums], "c_n", *[f"p_{c}" for c in lag_cols])

    # one row per (split key, sub-block): broadcast up to the bound of the split points
    cond = [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in keys] + [F.col(BLK) == F.col("_cblk")]
    out = local.join(F.broadcast(carries) if planned.total <= BROADCAST_POINTS else carries, cond, "left")
    for c in sums:
        carry, local_run = F.col(f"c_{c}"), F.col(f"_lrun_{c}")
        # SUM over only NULLs is NULL: stay NULL unless either part has a value
        out = out.withColumn(f"run_{c}", F.when(local_run.isNull() & carry.isNull(), F.lit(None))
                             .otherwise(F.coalesce(local_run, F.lit(0)) + F.coalesce(carry, F.lit(0))).cast(run_type[c]))
    if row_number:
        out = out.withColumn(row_number, F.col("_lrn") + F.coalesce(F.col("c_n"), F.lit(0)))
    for c in lag_cols:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_lrn") > 1, F.col(f"_llag_{c}"))
                             .otherwise(F.col(f"p_{c}")))
    drop = [BLK, "_is_split", "_lrn", "c_n", "_cblk", *[f"_lrun_{c}" for c in sums], *[f"c_{c}" for c in sums],
            *[f"_llag_{c}" for c in lag_cols], *[f"p_{c}" for c in lag_cols], *[f"_ck_{k}" for k in keys]]
    return out.drop(*drop)
