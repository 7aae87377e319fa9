"""Window operators (inventory W1-W12).

Two execution shapes are used, chosen per operator and stated in each
docstring:

* **Bounded per key** (top-N with a literal bound, windows over pre-aggregated
  periods): the built-in window. ``rank/dense_rank/row_number <= N`` gets a
  partial WindowGroupLimit before the exchange, so a hot key never ships more
  than about N rows per task.
* **Unbounded per key or global** (running totals, LAG over raw rows, row
  numbering for islands): :func:`quarry.operators.scan.ordered_scan`, which
  splits the ordered sequence into sampled blocks so neither a hot key nor a
  missing PARTITION BY funnels all rows into one task.

Money is summed as DECIMAL so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scan import MAX_BLOCKS, ROWS_PER_BLOCK, ordered_scan, plan_blocks


def _list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------- W1

def rank_columns(df: DataFrame, keys: str | Sequence[str], order: str, tiebreak: str,
                 descending: bool = True, n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK side by side, skew-safe.

    * ``row_number``: blocked ordered scan over ``(keys, order, tiebreak)``.
    * ``rank``: smallest row number among peers (a grouped aggregate on
      ``(keys, order)``, partially aggregated per task).
    * ``dense_rank``: row number of the distinct ``(keys, order)`` values,
      another blocked scan over that (smaller) table, joined back on the peer key.

    ``order`` must be numeric when ``descending`` (the scan sorts ascending on
    the negated value).
    """
    keys = _list(keys)
    o = F.col(order)
    # nulls first ascending, last descending
    by = ["_oa", "_o"]
    base = df.withColumn("_oa", (o.isNull() if descending else o.isNotNull()).cast("int")).withColumn("_o", -o if descending else o)
    numbered = ordered_scan(base, keys, [*by, tiebreak], n_blocks=n_blocks, row_number="row_number")
    peers = numbered.groupBy(*keys, *by).agg(F.min("row_number").alias("rank"))
    dense = ordered_scan(peers, keys, by, n_blocks=n_blocks, row_number="dense_rank")
    dense = dense.select(*[F.col(c).alias(f"_d{i}") for i, c in enumerate([*keys, *by])], "rank", "dense_rank")
    same = [F.col(c).eqNullSafe(F.col(f"_d{i}")) for i, c in enumerate([*keys, *by])]
    out = numbered.join(dense, same, "inner")  # null-safe: a null key or value is a peer group too
    return out.select(*df.columns, "row_number", "rank", "dense_rank")


# --------------------------------------------------------------------- W2

GROUP_LIMIT_THRESHOLD = 1000  # spark.sql.optimizer.windowGroupLimitThreshold (default)
TOP_N_SALTS = 256


def top_n_per_group(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], n: int,
                    kind: str = "dense_rank", rank_col: str = "rnk", salts: int = TOP_N_SALTS) -> DataFrame:
    """Top-N per group; ``dense_rank`` keeps ties (N distinct values), ``rank``
    keeps ties at the cut, ``row_number`` exactly N rows (needs a tie-break).

    With a literal N up to the group-limit threshold (1000) Spark inserts a
    partial WindowGroupLimit before the shuffle: every task forwards at most N
    rows per key plus ties, so a hot key costs one task-local top-N, not a
    shuffle of the key. Above the threshold the same two phases are written
    out: rank within ``(key, salt)`` (salt = hash of the row, so a recomputed
    task salts alike), keep ``<= N``, then rank again per key over at most
    ``N * salts`` rows. Exact for all three kinds: a row's rank within its
    salt part never exceeds its global rank, and every row ranked ahead of a
    kept row is kept.
    """
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
    keys = _list(keys)
    if n > GROUP_LIMIT_THRESHOLD:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt).withColumn("_r1", fn().over(w1))
              .where(F.col("_r1") <= n).drop("_r1", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w)).where(F.col(rank_col) <= n)


def top_n_values(df: DataFrame, keys: str | Sequence[str], value: str, n: int, kind: str = "dense_rank",
                 descending: bool = True, rank_col: str = "rnk") -> DataFrame:
    """Top-N per group by one value column, ties kept (``dense_rank``: the N
    best distinct values; ``rank``: rank <= N), without ranking tied rows.

    Rows are counted per ``(key, value)`` (the partial aggregate collapses
    ties inside each task), the distinct values are ranked per key with a
    bounded ``row_number() <= N`` (at most N per key and task), ``rank`` is
    one plus the count of strictly better rows, and the rows are joined
    back on ``(key, value)`` NULL-safely. A value tied across a third of a
    key's rows is then one row until the join, where AQE splits its
    partition; the window form would sort all of them in one task.
    Same result as ``top_n_per_group`` with ``F.col(value).desc()`` /
    ``.asc()`` ordering.
    """
    if kind not in ("dense_rank", "rank"):
        raise ValueError(kind)
    keys = _list(keys)
    o = F.col(value).desc() if descending else F.col(value).asc()
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt"))
    top = top_n_per_group(counts, keys, [o], n, kind="row_number", rank_col="_dv")
    if kind == "dense_rank":
        ranked = top.withColumnRenamed("_dv", rank_col)
    else:
        before = Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
        ranked = top.withColumn(rank_col, F.coalesce(F.sum("_cnt").over(before), F.lit(0)) + 1) \
            .where(F.col(rank_col) <= n)
    ranked = ranked.select(*[F.col(k).alias(f"_tk_{k}") for k in keys], F.col(value).alias("_tv"),
                           F.col(rank_col).cast("int").alias(rank_col))
    cond = [F.col(k).eqNullSafe(F.col(f"_tk_{k}")) for k in keys] + [F.col(value).eqNullSafe(F.col("_tv"))]
    return df.join(ranked, cond, "inner").drop(*[f"_tk_{k}" for k in keys], "_tv")


# --------------------------------------------------------------------- W3, W4, W10

def period_change(df: DataFrame, keys: str | Sequence[str] | None, order: str, value: str,
                  mode: str = "record", tiebreak: Sequence[str] = (), prev: str = "prev",
                  n_blocks: int | None = MAX_BLOCKS, period_step: Column | None = None) -> DataFrame:
    """Attach the previous period's value (LAG 1) per key.

    ``mode="record"``: the previous *row* in order (the quirk of the reference's
    "rising temperature": a gap of days still compares with the last record);
    runs as a blocked ordered scan, so it needs no single partition even with
    no key. ``mode="calendar"``: the previous calendar period ``order - 1`` (or
    ``period_step``), as an equi self-join on ``(keys, period)``; a missing
    period gives NULL.
    """
    keys = _list(keys)
    if mode == "record":
        out = ordered_scan(df, keys, [order, *tiebreak], lag_cols=[value], n_blocks=n_blocks,
                           row_number=None)
        return out.withColumnRenamed(f"prev_{value}", prev)
    if mode == "calendar":
        step = period_step if period_step is not None else F.col(order) - 1
        prior = df.select(*[F.col(k).alias(f"_pk_{k}") for k in keys],
                          F.col(order).alias("_p_next_src"), F.col(value).alias(prev))
        cur = df.withColumn("_p_prev_key", step)
        cond = [F.col(k).eqNullSafe(F.col(f"_pk_{k}")) for k in keys] + [F.col("_p_prev_key") == F.col("_p_next_src")]
        out = cur.join(prior, cond, "left")
        return out.drop("_p_prev_key", "_p_next_src", *[f"_pk_{k}" for k in keys])
    raise ValueError(mode)


def growth(df: DataFrame, keys: str | Sequence[str] | None, order: str, value: str,
           name: str = "growth", n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Period-over-period growth (W10): ``(v - prev) / prev``, NULL on the first
    period and on a zero previous value."""
    out = period_change(df, keys, order, value, prev="prev_value", n_blocks=n_blocks)
    return out.withColumn(name, F.try_divide(F.col(value) - F.col("prev_value"), F.col("prev_value")))


# --------------------------------------------------------------------- W6, W7

def running_total(df: DataFrame, keys: str | Sequence[str] | None, order: Sequence[str], value: str,
                  name: str = "running_total", n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED
    PRECEDING)`` (W6). ``order`` must make rows unique within a key (ROWS
    semantics). Blocked scan: no single partition for the global form, hot keys
    split."""
    out = ordered_scan(df, keys, order, sums=[value], n_blocks=n_blocks, row_number=None)
    return out.withColumnRenamed(f"run_{value}", name)


def _mean(value: Column, w) -> Column:
    n = F.count(value).over(w)
    return F.when(n > 0, F.sum(value).over(w) / n)


def moving_average(df: DataFrame, keys: str | Sequence[str] | None, order: Sequence[str], value: str,
                   rows: int = 7, name: str = "moving_avg", n_blocks: int | None = MAX_BLOCKS,
                   rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Average over the current and ``rows - 1`` preceding rows (W7, ROWS frame);
    NULL values do not count, no value at all gives NULL. ``order`` must make rows
    unique within a key.

    The frame runs as it stands while no key is hot. Otherwise rows are numbered by
    the blocked scan and cut into blocks of ``rows_per_block`` (``rows`` at least);
    the last ``rows - 1`` rows of a block are copied as a halo in front of the next
    one, so the plain ROWS frame within a block sees all it needs. No join back.
    """
    keys, order = _list(keys), _list(order)
    planned = plan_blocks(df, keys, order, rows_per_block, n_blocks)
    if planned is None:
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(1 - rows, 0)
        return df.withColumn(name, _mean(F.col(value), w))
    size = max(rows_per_block, rows)
    numbered = ordered_scan(df, keys, order, row_number="_rn", planned=planned)
    block, place = F.floor((F.col("_rn") - 1) / size), (F.col("_rn") - 1) % size
    copies = F.when(place > size - rows, F.array(block, block + 1)).otherwise(F.array(block))
    blocks = numbered.withColumn("_own", block).withColumn("_b", F.explode(copies))
    w = Window.partitionBy(*keys, "_b").orderBy("_rn").rowsBetween(1 - rows, 0)
    return blocks.withColumn(name, _mean(F.col(value), w)).where("_b = _own").select(*df.columns, name)


DAYS_PER_BLOCK = 4096


def calendar_moving_average(df: DataFrame, keys: str | Sequence[str] | None, day: str, value: str,
                            days: int = 7, name: str = "moving_avg_days", days_per_block: int = DAYS_PER_BLOCK) -> DataFrame:
    """``AVG(value) OVER (... ORDER BY day RANGE BETWEEN days-1 PRECEDING AND
    CURRENT ROW)`` over one row per (key, day) (W7, calendar form). A NULL day has
    no frame: NULL.

    Days are cut into blocks of ``days_per_block`` (``days`` at least) with a halo of
    the ``days - 1`` days before, and each block is a plain RANGE frame: one exchange,
    no join, and a key's days spread over its blocks.
    """
    keys = _list(keys)
    size = max(days_per_block, days)
    numbered = df.withColumn("_dn", day_number(day))
    block = F.floor(F.col("_dn") / size)
    copies = F.when(F.pmod("_dn", F.lit(size)) > size - days, F.array(block, block + 1)).otherwise(F.array(block))
    blocks = numbered.withColumn("_own", block).withColumn("_b", F.explode(copies))
    w = Window.partitionBy(*keys, "_b").orderBy("_dn").rangeBetween(1 - days, 0)
    mean = F.when(F.col("_dn").isNotNull(), F.avg(value).over(w))
    return blocks.withColumn(name, mean).where(F.col("_b").eqNullSafe(F.col("_own"))).select(*df.columns, name)


# --------------------------------------------------------------------- W5, W8, W9

def islands(df: DataFrame, keys: str | Sequence[str], seq: str, dedupe: bool = False,
            n_blocks: int | None = MAX_BLOCKS, start: str = "start", end: str = "end", size: str = "n") -> DataFrame:
    """Maximal runs of consecutive integers per key.

    Island id = ``seq - row_number()``; then one grouped aggregate gives start,
    end and size. The row number comes from the blocked scan, so a key with
    millions of rows is numbered by many tasks. With duplicate sequence values
    the plain ROW_NUMBER form splits a run at the duplicate (the reference's
    behaviour); ``dedupe=True`` removes duplicates first.
    """
    keys = _list(keys)
    base = df.select(*keys, seq)
    if dedupe:
        base = base.distinct()
    # rows tied on (keys, seq) are identical here, so any order among them
    # gives the same islands
    numbered = ordered_scan(base, keys, [seq], n_blocks=n_blocks, row_number="_rn")
    isl = numbered.withColumn("_island", F.col(seq) - F.col("_rn"))
    return isl.groupBy(*keys, "_island").agg(F.min(seq).alias(start), F.max(seq).alias(end),
                                             F.count(F.lit(1)).alias(size)).drop("_island")


def day_number(c: str | Column) -> Column:
    """Days since 1970-01-01, the integer sequence for date islands."""
    col = F.col(c) if isinstance(c, str) else c
    return F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date"))


def day_islands(df: DataFrame, keys: str | Sequence[str], day: str, n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Runs of consecutive calendar days per key, from distinct (key, day)."""
    keys = _list(keys)
    days = df.select(*keys, day_number(day).alias("_dn")).distinct()
    isl = islands(days, keys, "_dn", dedupe=True, n_blocks=n_blocks, start="_s", end="_e", size="days")
    return isl.select(*keys, F.date_add(F.lit("1970-01-01").cast("date"), F.col("_s").cast("int")).alias("start_day"),
                      F.date_add(F.lit("1970-01-01").cast("date"), F.col("_e").cast("int")).alias("end_day"),
                      "days")


def streak_keys(df: DataFrame, keys: str | Sequence[str], day: str, n: int,
                n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Keys active on at least ``n`` consecutive days (W5); the LEAD(d, n-1) =
    d + n - 1 test on distinct days is the same as an island of length >= n."""
    keys = _list(keys)
    return day_islands(df, keys, day, n_blocks).where(F.col("days") >= n).select(*keys).distinct()


def longest_streak(df: DataFrame, keys: str | Sequence[str], day: str, name: str = "longest",
                   n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Longest run of consecutive active days per key."""
    keys = _list(keys)
    return day_islands(df, keys, day, n_blocks).groupBy(*keys).agg(F.max("days").alias(name))


# --------------------------------------------------------------------- W11

def cohort_retention(df: DataFrame, user: str, period: Column) -> DataFrame:
    """Cohort matrix (W11): cohort = user's first period; ``offset`` = periods
    since; ``users`` = distinct active users.

    ``period`` must be an integer period number (e.g. ``year*12 + month``).
    Distinct (user, period) pairs are formed once (partial aggregation before
    the shuffle). After that a user holds at most one row per period, so the
    first period per user is a window MIN over a group bounded by the number
    of periods, not by the user's activity (a hot user is one row per
    period); no join back. The final count needs no COUNT(DISTINCT) because
    the pairs are already unique.
    """
    act = df.select(F.col(user).alias("_u"), period.alias("_p")).where(F.col("_u").isNotNull()).distinct()
    j = act.withColumn("cohort", F.min("_p").over(Window.partitionBy("_u")))
    return (j.groupBy("cohort", (F.col("_p") - F.col("cohort")).alias("offset"))
            .agg(F.count(F.lit(1)).alias("users")))


def month_number(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.year(col) * 12 + F.month(col) - 1


def month_of_number(n: str | Column) -> Column:
    """Inverse of :func:`month_number` as ``YYYY-MM`` text."""
    col = F.col(n) if isinstance(n, str) else n
    return F.format_string("%04d-%02d", F.floor(col / 12).cast("int"), (col % 12 + 1).cast("int"))


# --------------------------------------------------------------------- W12

def window_profile(df: DataFrame, keys: str | Sequence[str], order: str, value: str) -> DataFrame:
    """Several window functions over one specification (W12): share of the
    key's total, rank by value, previous value in order.

    For inputs bounded per key (pre-aggregated periods): all three share one
    ``PARTITION BY keys`` exchange; the two orderings need two sorts inside it.
    """
    keys = _list(keys)
    by_key = Window.partitionBy(*keys)
    by_order = by_key.orderBy(F.col(order).asc_nulls_first())
    by_value = by_key.orderBy(F.col(value).desc_nulls_last(), F.col(order).asc_nulls_first())
    # the total is summed in the value's own type (DECIMAL stays exact), then
    # both sides go to double for the ratio
    share = F.col(value).cast("double") / F.sum(value).over(by_key).cast("double")
    return (df.withColumn("share", share)
            .withColumn("value_rank", F.rank().over(by_value))
            .withColumn("prev_value", F.lag(value, 1).over(by_order)))
