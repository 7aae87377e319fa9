"""Join operators (inventory J1-J6, F8).

Broadcasts are never assumed: a side is broadcast only after a bounded-cost
check proves it small; otherwise the join is left to the planner (sort-merge,
or AQE's runtime switch to broadcast, and AQE skew-join splitting of hot
partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 100_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when it has at most ``max_rows`` rows.

    The proof is ``take(max_rows + 1)`` of a one-column projection (a literal,
    so the scan reads no data columns). ``take`` runs incrementally: one
    partition first, then more (``spark.sql.limit.scaleUpFactor``) only while
    rows are missing, so a large side stops after about ``max_rows`` rows
    instead of launching a task on every partition, as ``limit().count()``
    would. At most ``max_rows + 1`` one-field rows reach the driver. Above
    the bound the DataFrame comes back unmarked and the planner shuffles.
    """
    n = len(df.select(F.lit(1).alias("_one")).take(max_rows + 1))
    return F.broadcast(df) if n <= max_rows else df


def equi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column,
              how: str = "inner", small_right_rows: int | None = None) -> DataFrame:
    """Equi-join (J1/J2/J4); ``small_right_rows`` asks for a checked broadcast."""
    if small_right_rows:
        right = broadcast_if_bounded(right, small_right_rows)
    return left.join(right, on, how)


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``left`` with no match in ``right``.

    Written as ``left_anti``: the literal ``LEFT JOIN ... WHERE r.key IS NULL``
    is planned as an outer join plus a filter, which ships every matched pair
    through the join first.
    """
    return left.join(right, on, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``left`` with at least one match (IN / EXISTS, F8)."""
    return left.join(right, on, "left_semi")


def not_in(left: DataFrame, col: str, right: DataFrame, right_col: str) -> DataFrame:
    """SQL ``left.col NOT IN (SELECT right_col FROM right)`` (F8).

    Null-aware: a NULL in ``right`` empties the result, and a NULL ``col`` is
    kept only when ``right`` is empty. Spark's own null-aware anti join needs a
    broadcastable right side (otherwise a nested-loop join); here the NULL rules
    become two uncorrelated EXISTS flags and the match is a plain hash/sort
    anti join that scales on both sides.
    """
    vals = right.select(F.col(right_col).alias("_v"))
    has_null = vals.where(F.col("_v").isNull()).exists()
    non_empty = vals.exists()
    matched = left.join(vals.where(F.col("_v").isNotNull()),
                        F.col(col) == F.col("_v"), "left_anti")
    return matched.where(~has_null & (F.col(col).isNotNull() | ~non_empty))


def next_row_pairs(df: DataFrame, keys: Sequence[str], seq: str,
                   left_cols: Sequence[str], right_cols: Sequence[str],
                   step: int = 1) -> DataFrame:
    """Self join of each row with the row ``step`` positions later in the same
    key (J5), ``a.seq + step = b.seq``: an equi-join on (keys, seq), so every
    row meets at most one partner and no group emits all its pairs."""
    a = df.select(*keys, F.col(seq).alias("_seq_a"), *[F.col(c).alias(f"a_{c}") for c in left_cols])
    b = df.select(*[F.col(k).alias(f"_bk_{k}") for k in keys], F.col(seq).alias("_seq_b"),
                  *[F.col(c).alias(f"b_{c}") for c in right_cols])
    cond = [F.col(k) == F.col(f"_bk_{k}") for k in keys] + [F.col("_seq_a") + step == F.col("_seq_b")]
    out = a.join(b, cond, "inner")
    return out.drop(*[f"_bk_{k}" for k in keys])


def reconcile(old: DataFrame, new: DataFrame, key: str | Sequence[str],
              compare: Sequence[str]) -> DataFrame:
    """Keyed snapshot reconciliation (J6): one full outer join on the key.

    Output: key columns, ``status`` in added / removed / changed / same, and
    ``changed_cols`` (names of the compared columns that differ, NULL-safe).
    """
    keys = [key] if isinstance(key, str) else list(key)
    o = old.select(*keys, *[F.col(c).alias(f"o_{c}") for c in compare], F.lit(True).alias("_in_old"))
    n = new.select(*keys, *[F.col(c).alias(f"n_{c}") for c in compare], F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    diffs = F.filter(F.array(*[F.when(~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")), F.lit(c))
                               for c in compare]), lambda x: x.isNotNull())
    status = (F.when(F.col("_in_old").isNull(), "added")
              .when(F.col("_in_new").isNull(), "removed")
              .when(F.size(diffs) > 0, "changed").otherwise("same"))
    return j.select(*keys, status.alias("status"),
                    F.when(F.col("_in_old") & F.col("_in_new"), diffs).alias("changed_cols"))
