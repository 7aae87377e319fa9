"""Plans for window operators (inventory W1-W12) over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.expr import money
from quarry.operators import joins
from quarry.operators import windows as win
from quarry.plans.core import DIM_ROWS, REVENUE_SQL, revenue_expr
from quarry.plans.registry import plan
from quarry.sources.tables import Tables


def daily_revenue(t: Tables) -> DataFrame:
    """Exact revenue per ship day (DECIMAL); one row per day, bounded by the
    calendar, not by the data."""
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.sum(revenue_expr()).alias("revenue"))


DAILY_SQL = f"SELECT CAST(l_shipdate AS DATE) AS day, SUM({REVENUE_SQL}) AS revenue FROM lineitem GROUP BY 1"


def purchase_days(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "purchase").select("user_id", F.to_date("ts").alias("day"))


@plan("w1_ranks", """
SELECT c_custkey, c_nationkey, c_acctbal,
  ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS row_number,
  RANK() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank,
  DENSE_RANK() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS dense_rank
FROM customer""")
def w1(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", "c_acctbal")
    r = win.rank_columns(c, "c_nationkey", "c_acctbal", "c_custkey", descending=True)
    return r.select("c_custkey", "c_nationkey", "c_acctbal", *[F.col(x).cast("bigint").alias(x)
                                                              for x in ("row_number", "rank", "dense_rank")])


@plan("w2_top3_per_nation", """
SELECT n_name, c_custkey, c_name, c_acctbal, CAST(rnk AS BIGINT) AS rnk FROM (
  SELECT n.n_name, c.c_custkey, c.c_name, c.c_acctbal,
         DENSE_RANK() OVER (PARTITION BY c.c_nationkey ORDER BY c.c_acctbal DESC) AS rnk
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) t WHERE rnk <= 3""")
def w2_top3_per_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: top-3 balances per nation with ties (dense rank), the nation
    name joined from a checked-size broadcast. The rank filter is planned as a
    partial WindowGroupLimit before the exchange."""
    t = Tables(spark, sf)
    j = t.customer.join(joins.broadcast_if_bounded(t.nation, DIM_ROWS),
                        F.col("c_nationkey") == F.col("n_nationkey"))
    top = win.top_n_values(j, "c_nationkey", "c_acctbal", 3)
    return top.select("n_name", "c_custkey", "c_name", "c_acctbal", F.col("rnk").cast("bigint").alias("rnk"))


@plan("w2_top1_per_priority_rank", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT o_orderpriority, o_orderkey, o_totalprice,
         RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS r FROM orders) t WHERE r = 1""")
def w2_top1(spark, sf):
    o = Tables(spark, sf).orders
    top = win.top_n_values(o, "o_orderpriority", "o_totalprice", 1, kind="rank")
    return top.select("o_orderpriority", "o_orderkey", "o_totalprice")


@plan("w3_global_lag_rises", f"""
WITH daily AS ({DAILY_SQL}),
p AS (SELECT day, revenue, LAG(revenue) OVER (ORDER BY day) AS prev FROM daily)
SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_revenue
FROM p WHERE prev IS NOT NULL AND revenue > prev""")
def w3(spark, sf):
    """Previous *record* (not previous calendar day), over the whole relation:
    the blocked scan avoids the single-partition window."""
    d = win.period_change(daily_revenue(Tables(spark, sf)), None, "day", "revenue", prev="prev")
    return d.where(F.col("prev").isNotNull() & (F.col("revenue") > F.col("prev"))).select(
        "day", F.col("revenue").cast("double").alias("revenue"), F.col("prev").cast("double").alias("prev_revenue"))


@plan("w3_calendar_prev_day", f"""
WITH daily AS ({DAILY_SQL})
SELECT a.day, CAST(a.revenue AS DOUBLE) AS revenue, CAST(b.revenue AS DOUBLE) AS prev_revenue
FROM daily a LEFT JOIN daily b ON b.day = a.day - INTERVAL 1 DAY""")
def w3_calendar(spark, sf):
    """Calendar mode: the previous calendar day (NULL when that day has no
    rows), as an equi self-join."""
    d = daily_revenue(Tables(spark, sf))
    out = win.period_change(d, None, "day", "revenue", mode="calendar", prev="prev",
                            period_step=F.date_sub("day", 1))
    return out.select("day", F.col("revenue").cast("double").alias("revenue"),
                      F.col("prev").cast("double").alias("prev_revenue"))


@plan("w4_monthly_drops", """
WITH m AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2),
p AS (SELECT o_orderpriority, month, n, LAG(n) OVER (PARTITION BY o_orderpriority ORDER BY month) AS prev_n FROM m)
SELECT o_orderpriority, month, n, prev_n FROM p WHERE prev_n IS NOT NULL AND n < prev_n""")
def w4(spark, sf):
    o = Tables(spark, sf).orders
    m = o.groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")) \
        .agg(F.count(F.lit(1)).alias("n"))
    p = win.period_change(m, "o_orderpriority", "month", "n", prev="prev_n")
    return p.where(F.col("prev_n").isNotNull() & (F.col("n") < F.col("prev_n"))) \
        .select("o_orderpriority", "month", "n", "prev_n")


@plan("w5_streak3", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
l AS (SELECT user_id, day, LEAD(day, 1) OVER (PARTITION BY user_id ORDER BY day) AS d1,
             LEAD(day, 2) OVER (PARTITION BY user_id ORDER BY day) AS d2 FROM d)
SELECT DISTINCT user_id FROM l WHERE d1 = day + INTERVAL 1 DAY AND d2 = day + INTERVAL 2 DAY""")
def w5(spark, sf):
    return win.streak_keys(purchase_days(Tables(spark, sf)), "user_id", "day", 3)


@plan("w6_running_daily", f"""
WITH daily AS ({DAILY_SQL})
SELECT day, CAST(revenue AS DOUBLE) AS revenue,
  CAST(SUM(revenue) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM daily""")
def w6_daily(spark, sf):
    d = win.running_total(daily_revenue(Tables(spark, sf)), None, ["day"], "revenue")
    return d.select("day", F.col("revenue").cast("double").alias("revenue"),
                    F.col("running_total").cast("double").alias("running_total"))


@plan("w6_running_customer", """
SELECT o_custkey, o_orderkey, o_totalprice,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM orders""")
def w6_customer(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                                        money("o_totalprice").alias("price"))
    r = win.running_total(o, "o_custkey", ["o_orderdate", "o_orderkey"], "price")
    return r.select("o_custkey", "o_orderkey", "o_totalprice", F.col("running_total").cast("double").alias("running_total"))


@plan("w7_moving_avg_rows", f"""
WITH daily AS ({DAILY_SQL})
SELECT day, ROUND(AVG(revenue) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM daily""")
def w7_rows(spark, sf):
    d = win.moving_average(daily_revenue(Tables(spark, sf)), None, ["day"], "revenue", rows=7)
    return d.select("day", F.round(F.col("moving_avg").cast("double"), 6).alias("moving_avg"))


@plan("w7_moving_avg_days", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, SUM(CAST(value AS DECIMAL(18,2))) AS v
           FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT user_id, day, ROUND(AVG(v) OVER (PARTITION BY user_id ORDER BY day
       RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 6) AS moving_avg_days
FROM d""")
def w7_days(spark, sf):
    ev = Tables(spark, sf).events.where(F.col("event_type") == "purchase")
    d = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum(money("value")).alias("v"))
    out = win.calendar_moving_average(d, "user_id", "day", "v", days=7)
    return out.select("user_id", "day", F.round(F.col("moving_avg_days").cast("double"), 6).alias("moving_avg_days"))


@plan("w8_islands_days", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
g AS (SELECT user_id, day, day - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp FROM d)
SELECT user_id, MIN(day) AS start_day, MAX(day) AS end_day, COUNT(*) AS days FROM g GROUP BY user_id, grp""")
def w8_days(spark, sf):
    return win.day_islands(purchase_days(Tables(spark, sf)), "user_id", "day")


@plan("w8_islands_lines", """
WITH valid AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line FROM lineitem WHERE l_returnflag <> 'R'),
g AS (SELECT l_orderkey, line, line - ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY line) AS k FROM valid)
SELECT l_orderkey, MIN(line) AS start_line, MAX(line) AS end_line, COUNT(*) AS num_lines FROM g GROUP BY l_orderkey, k""")
def w8_lines(spark, sf):
    """Runs of consecutive line numbers per order after dropping 'R' lines
    (the reference's check-number runs); duplicate numbers split a run, as
    ROW_NUMBER does."""
    li = Tables(spark, sf).lineitem.where(F.col("l_returnflag") != "R") \
        .select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"))
    return win.islands(li, "l_orderkey", "line", start="start_line", end="end_line", size="num_lines")


@plan("w9_longest_streak", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
g AS (SELECT user_id, day - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp FROM d),
r AS (SELECT user_id, COUNT(*) AS days FROM g GROUP BY user_id, grp)
SELECT user_id, MAX(days) AS longest FROM r GROUP BY user_id""")
def w9(spark, sf):
    return win.longest_streak(purchase_days(Tables(spark, sf)), "user_id", "day")


@plan("w10_mom_growth", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
           FROM orders GROUP BY 1),
p AS (SELECT month, revenue, LAG(revenue) OVER (ORDER BY month) AS prev_value FROM m)
SELECT month, revenue, prev_value, (revenue - prev_value) / prev_value AS growth FROM p""")
def w10(spark, sf):
    o = Tables(spark, sf).orders
    m = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")) \
        .agg(F.sum(money("o_totalprice")).cast("double").alias("revenue"))
    return win.growth(m, None, "month", "revenue").select("month", "revenue", "prev_value", "growth")


@plan("w11_cohort", """
WITH a AS (SELECT DISTINCT o_custkey AS u, YEAR(o_orderdate) * 12 + MONTH(o_orderdate) - 1 AS p FROM orders),
f AS (SELECT u, MIN(p) AS c FROM a GROUP BY u)
SELECT printf('%04d-%02d', f.c // 12, f.c % 12 + 1) AS cohort, CAST(a.p - f.c AS BIGINT) AS "offset", COUNT(*) AS users
FROM a JOIN f ON a.u = f.u GROUP BY 1, 2""")
def w11(spark, sf):
    o = Tables(spark, sf).orders
    c = win.cohort_retention(o, "o_custkey", win.month_number("o_orderdate"))
    return c.select(win.month_of_number("cohort").alias("cohort"), F.col("offset").cast("bigint").alias("offset"),
                    "users")


@plan("w12_profile", """
WITH m AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS rev
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, month, CAST(rev AS DOUBLE) AS revenue,
  CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER (PARTITION BY o_orderpriority) AS DOUBLE) AS share,
  RANK() OVER (PARTITION BY o_orderpriority ORDER BY rev DESC, month ASC) AS value_rank,
  CAST(LAG(rev) OVER (PARTITION BY o_orderpriority ORDER BY month) AS DOUBLE) AS prev_value
FROM m""")
def w12(spark, sf):
    """Monthly revenue per priority (bounded: priorities x months), profiled
    with three window functions over one partitioning."""
    o = Tables(spark, sf).orders
    m = o.groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")) \
        .agg(F.sum(money("o_totalprice")).alias("rev"))
    p = win.window_profile(m, "o_orderpriority", "month", "rev")
    return p.select("o_orderpriority", "month", F.col("rev").cast("double").alias("revenue"), "share",
                    F.col("value_rank").cast("bigint").alias("value_rank"),
                    F.col("prev_value").cast("double").alias("prev_value"))


@plan("a8_range_summary", """
WITH y AS (SELECT DISTINCT o_custkey, YEAR(o_orderdate) AS yr FROM orders),
g AS (SELECT o_custkey, yr, yr - ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY yr) AS grp FROM y)
SELECT o_custkey, CAST(MIN(yr) AS BIGINT) AS first_year, CAST(MAX(yr) AS BIGINT) AS last_year, COUNT(*) AS years
FROM g GROUP BY o_custkey, grp""")
def a8(spark, sf):
    """MIN / MAX / COUNT per derived group: runs of consecutive order years
    per customer (the group is the island id)."""
    o = Tables(spark, sf).orders.select("o_custkey", F.year("o_orderdate").cast("bigint").alias("yr"))
    return win.islands(o, "o_custkey", "yr", dedupe=True, start="first_year", end="last_year", size="years")
