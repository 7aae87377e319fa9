"""Relational operators: filters, aggregates, top-k, percentiles, set operations
(inventory F1-F9, A1-A9, O1-O4, U1-U2).

Aggregations are plain ``groupBy().agg()``: Spark runs a partial (map-side)
aggregate before the exchange, so a hot key is reduced to one row per task
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scan import MAX_BLOCKS, ordered_scan
from quarry.operators.windows import top_n_per_group
from quarry.session import written_table


def _list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------- filters / projections

def filter_project(df: DataFrame, condition: Column, cols: Sequence[str | Column]) -> DataFrame:
    """Conjunctive filter then projection (F1); the filter reaches the scan."""
    return df.where(condition).select(*cols)


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DISTINCT projection (F2): partial aggregate per task, then one shuffle."""
    return df.select(*cols).distinct()


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL replacement (F4, M10) keeping every other column."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def null_rows(df: DataFrame, col: str, is_null: bool = True) -> DataFrame:
    """IS NULL / IS NOT NULL filter."""
    return df.where(F.col(col).isNull() if is_null else F.col(col).isNotNull())


def above_scalar(df: DataFrame, col: str, stat: str = "avg") -> DataFrame:
    """Rows whose ``col`` exceeds a whole-table statistic.

    The statistic is an uncorrelated scalar subquery: Spark evaluates it once,
    as a separate one-row aggregate, and the filter stays a map-side predicate.
    """
    agg = getattr(F, stat)(F.col(col))
    return df.where(F.col(col) > df.select(agg).scalar())


def above_group_stat(df: DataFrame, group: str | Sequence[str], col: str,
                     stat: str = "avg") -> DataFrame:
    """Correlated-subquery form (F9): rows above their own group's statistic.

    Decorrelated into a grouped aggregate (one row per group, partially
    aggregated) joined back on the group key. The aggregate's size is only
    known after it runs, so the join strategy is left to AQE, which measures
    the shuffled aggregate and switches to a broadcast join when it is under
    the broadcast threshold (a runtime size check with no extra job); beyond
    it the join stays sort-merge. The null-safe condition keeps an exchange on
    the aggregate's side, without which AQE cannot split a hot group's rows;
    null groups match nothing, as in SQL. A window over the group would put a
    hot group in one task.
    """
    keys = _list(group)
    some = df
    for k in keys:
        some = some.where(F.col(k).isNotNull())
    stats = some.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(getattr(F, stat)(F.col(col)).alias("_stat"))
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    return (some.join(stats, same, "inner").where(F.col(col) > F.col("_stat"))
            .drop("_stat", *[f"_g_{k}" for k in keys]))


# --------------------------------------------------------------------- aggregates

def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """COUNT(*) per group (A1)."""
    return df.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], min_count: int = 2,
                   name: str = "n") -> DataFrame:
    """GROUP BY ... HAVING COUNT(*) >= min_count."""
    return count_by(df, keys, name).where(F.col(name) >= min_count)


def conditional_sums(df: DataFrame, keys: str | Sequence[str],
                     cases: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)`` per output column (A5)."""
    aggs = [F.sum(F.when(cond, value).otherwise(F.lit(0))).alias(name)
            for name, (cond, value) in cases.items()]
    return df.groupBy(*_list(keys)).agg(*aggs)


def pivot_counts(df: DataFrame, keys: str | Sequence[str], pivot_col: str,
                 values: Sequence[str], prefix: str = "n_") -> DataFrame:
    """Count by category, wide (A9). The pivot values are given, so Spark does
    not run an extra job to discover them; missing combinations become 0."""
    wide = df.groupBy(*_list(keys)).pivot(pivot_col, list(values)).count()
    return wide.select(*_list(keys), *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint")
                                       .alias(f"{prefix}{v}") for v in values])


def nth_highest(df: DataFrame, col: str, n: int, name: str | None = None) -> DataFrame:
    """The n-th highest *distinct* value, one row, NULL if there are fewer.

    Distinct values first (a grouped aggregate; the partial aggregate
    collapses repeats inside each task), then ``row_number() <= n`` over
    them as a bounded top-N (a partial WindowGroupLimit per task, or the
    salted two-phase form above its threshold). Ranking rows with
    ``dense_rank`` instead would keep every tied row, so a value held by a
    third of the table would reach the single final task whole.
    """
    name = name or col
    vals = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    top = top_n_per_group(vals, [], [F.col("_v").desc()], n, kind="row_number", rank_col="_dr")
    return top.agg(F.when(F.max("_dr") == n, F.min("_v")).alias(name))


def top_k(df: DataFrame, order: Sequence[Column], k: int, pos: str = "pos") -> DataFrame:
    """Top-k rows with a full tie-break (O1-O3), plus their 1-based position.

    ``orderBy().limit()`` becomes TakeOrderedAndProject: each task keeps its
    own k best rows, the driver-side merge sees at most k rows per task. The
    position is numbered over those k rows only.
    """
    top = df.orderBy(*order).limit(k)
    return top.withColumn(pos, F.row_number().over(Window.orderBy(*order)))


def tie_audit(df: DataFrame, key: str, k: int, descending: bool = True) -> DataFrame:
    """Is a top-k cut on ``key`` ambiguous (O4)?

    One aggregate pass plus the k-th key (itself a top-k): ``better`` counts
    rows strictly ahead of the k-th key, ``at_kth`` rows equal to it. The cut is
    ambiguous when ``better < k < better + at_kth``: rows tied at the k-th key
    straddle the boundary, so the chosen rows depend on arrival order.
    """
    # nulls stand where the top-k puts them: last descending, first ascending
    rank = F.struct(F.col(key).isNotNull().alias("present"), F.col(key).alias("value"))
    kth = (df.select(rank.alias("_r")).orderBy(F.col("_r").desc() if descending else F.col("_r").asc()).limit(k)
           .agg(F.when(F.count(F.lit(1)) == k, F.min("_r") if descending else F.max("_r")).alias("_kth")))
    at, exists = kth.select("_kth.value").scalar(), kth.select("_kth").scalar().isNotNull()
    null, at_null = F.col(key).isNull(), at.isNull()
    if descending:
        ahead = F.when(at_null, ~null).otherwise(F.col(key) > at)
    else:
        ahead = F.when(at_null, F.lit(False)).otherwise(null | (F.col(key) < at))
    stats = df.agg(F.count_if(exists & ahead).alias("better"), F.count_if(exists & F.col(key).eqNullSafe(at)).alias("at_kth"))
    return stats.select(
        F.lit(k).cast("bigint").alias("k"), at.alias("kth_value"),
        F.col("better"), F.col("at_kth"),
        ((F.col("better") < k) & (F.col("better") + F.col("at_kth") > k)).alias("ambiguous"))


# --------------------------------------------------------------------- percentiles

def exact_percentile(df: DataFrame, group: str | Sequence[str] | None, col: str, p: float,
                     method: str = "cont", name: str = "pct", n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Exact ``percentile_cont`` / ``percentile_disc`` per group, skew-safe;
    one percentile of :func:`exact_percentiles`."""
    return exact_percentiles(df, group, col, [(p, method, name)], n_blocks)


def exact_percentiles(df: DataFrame, group: str | Sequence[str] | None, col: str,
                      specs: Sequence[tuple[float, str, str]], n_blocks: int | None = MAX_BLOCKS) -> DataFrame:
    """Several exact percentiles per group (``specs``: ``(p, "cont"|"disc",
    name)``) from one scan.

    Built-in ``percentile``/``median`` buffer every value of a group in one
    task. Here values are first counted per ``(group, value)`` (the partial
    aggregate collapses repeated values), then a blocked ordered scan
    (:func:`quarry.operators.scan.ordered_scan`) gives each distinct value its
    cumulative count, so a hot group is spread over many tasks. The ranks
    every percentile needs (two for ``cont``, one for ``disc``) are picked in
    one more grouped aggregate.
    """
    keys = _list(group)
    vals = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    if not keys:  # counted once, then read by the scan and for the total
        vals = written_table(vals, "values")
    scanned = ordered_scan(vals, keys, [col], sums=["_c"], n_blocks=n_blocks, row_number=None)
    totals = vals.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    if keys:
        totals = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_n")
        j = scanned.join(totals, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys], "inner")
    else:  # one number, used in every condition below
        j = scanned.withColumn("_n", F.lit(totals.first()[0]).cast("bigint"))
    cum, cnt, n = F.col("run__c"), F.col("_c"), F.col("_n")

    def holds(rank: Column) -> Column:  # the value at 1-based position ``rank``
        return (cum - cnt < rank) & (rank <= cum)

    def h_of(p: float, total: Column) -> Column:
        return F.lit(1.0) + F.lit(p) * (total - 1)

    conds, aggs, finals = [], [], []
    for i, (p, method, name) in enumerate(specs):
        if method == "cont":
            h = h_of(p, n)
            lo, hi = holds(F.floor(h)), holds(F.ceil(h))
            conds += [lo, hi]
            aggs += [F.max(F.when(lo, F.col(col))).alias(f"_vlo{i}"), F.max(F.when(hi, F.col(col))).alias(f"_vhi{i}")]
            hh = h_of(p, F.col("_n"))
            frac = hh - F.floor(hh)
            finals.append((F.col(f"_vlo{i}") + frac * (F.col(f"_vhi{i}") - F.col(f"_vlo{i}"))).alias(name))
        elif method == "disc":
            # smallest value whose cumulative share reaches p
            hit = holds(F.greatest(F.ceil(F.lit(p) * n), F.lit(1)))
            conds.append(hit)
            aggs.append(F.min(F.when(hit, F.col(col))).alias(f"_vd{i}"))
            finals.append(F.col(f"_vd{i}").alias(name))
        else:
            raise ValueError(method)
    any_hit = conds[0]
    for c in conds[1:]:
        any_hit = any_hit | c
    agg = j.where(any_hit).groupBy(*keys).agg(*aggs, F.max("_n").alias("_n"))
    return agg.select(*keys, *finals)


SKETCH_K = 400           # normalised rank error of about 1% at 99% confidence
SKETCH_ERROR = 0.02      # stated bound, for results that are checked


def quantile_sketches(df: DataFrame, group: str | Sequence[str] | None, col: str, k: int = SKETCH_K, name: str = "sketch") -> DataFrame:
    """One KLL quantile sketch per group (A7 at scale): a few kilobytes whatever the
    group's size, built per task and merged, so no value is shuffled. NULLs are left out;
    a group of NULLs has a NULL sketch. The sketch is a binary column to be stored and
    merged later (:func:`merge_sketches`)."""
    return df.groupBy(*_list(group)).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias(name))


def merge_sketches(sketches: DataFrame, group: str | Sequence[str] | None, name: str = "sketch", k: int = SKETCH_K) -> DataFrame:
    """Sketches of parts (days, files) merged into one per ``group``: percentiles of
    the union without reading its rows again."""
    return sketches.groupBy(*_list(group)).agg(F.kll_merge_agg_double(F.col(name), F.lit(k)).alias(name))


def sketch_percentiles(sketches: DataFrame, specs: Sequence[tuple[float, str]], name: str = "sketch") -> DataFrame:
    """Approximate percentiles from sketches; ``specs``: ``(p, column)``. The rank of
    each is within ``SKETCH_ERROR`` of ``p`` (normalised), for ``SKETCH_K``."""
    rest = [c for c in sketches.columns if c != name]
    return sketches.select(*rest, *[F.kll_sketch_get_quantile_double(F.col(name), F.lit(float(p))).alias(out) for p, out in specs])


# --------------------------------------------------------------------- set operations

def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION (distinct), columns matched by name."""
    return a.unionByName(b).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT (distinct)."""
    return a.subtract(b.select(*a.columns))


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT ALL (multiset)."""
    return a.exceptAll(b.select(*a.columns))


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """INTERSECT (companion of U1/U2)."""
    return a.intersect(b.select(*a.columns))
