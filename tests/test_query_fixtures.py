"""The reference's query shapes on small hand-made tables; expected results
are written by hand from the definitions (not produced by this code)."""

from datetime import date

from pyspark.sql import functions as F

from conftest import rows
from quarry.functions.expr import band, money, round_half_up
from quarry.operators import joins, relational as rel, windows as win


def test_f1_filter_threshold_excluded(spark):
    emp = spark.createDataFrame([(1, "kelp", 3.5, 7), (2, "moss", 9.25, 7), (3, "fern", 12.0, 4),
                                 (4, "reed", 3.0, 7), (5, "sage", 4.0, 7), (6, "dock", None, 7)],
                                "id long, name string, height double, plot long")
    out = rel.filter_project(emp, (F.col("plot") == 7) & (F.col("height") > 3.5), ["name"])
    assert rows(out) == [("moss",), ("sage",)]


def test_f2_distinct(spark):
    emp = spark.createDataFrame([(1, "dev"), (2, "ops"), (3, "dev"), (4, "qa"), (5, "ops"), (6, "lead")],
                                "id long, title string")
    assert rows(rel.distinct_rows(emp, ["title"])) == [("dev",), ("lead",), ("ops",), ("qa",)]


def test_o2_top_k_tie_broken_by_name(spark):
    emp = spark.createDataFrame([(1, "Bo", 90.0), (2, "Ana", 90.0), (3, "Cat", 80.0), (4, "Dan", 70.0), (5, "Ed", 85.0)],
                                "id long, name string, salary double")
    out = rel.top_k(emp, [F.col("salary").desc(), F.col("name").asc()], 3)
    assert sorted((r.pos, r.name, r.salary) for r in out.collect()) == [(1, "Ana", 90.0), (2, "Bo", 90.0), (3, "Ed", 85.0)]


def test_o3_bottom_k(spark):
    laps = spark.createDataFrame([(1, "A", 71.2), (2, "B", 70.9), (3, "C", 71.05), (4, "D", 72.0)],
                                 "lap_id long, driver string, secs double")
    out = rel.top_k(laps, [F.col("secs").asc(), F.col("lap_id").asc()], 3)
    assert sorted((r.pos, r.driver) for r in out.collect()) == [(1, "B"), (2, "C"), (3, "A")]


def test_a1_count_by_unequal_groups(spark):
    emp = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (6, 3)], "id long, dept long")
    assert rows(rel.count_by(emp, "dept", "employee_count")) == [(1, 2), (2, 1), (3, 3)]


def test_j1_inner_join_and_j4_left(spark):
    emp = spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, "C", 3)], "id long, name string, dept long")
    dept = spark.createDataFrame([(1, "Eng"), (2, "Ops")], "dept long, dept_name string")
    inner = joins.equi_join(emp, dept, "dept", small_right_rows=100)
    assert rows(inner, "name", "dept_name") == [("A", "Eng"), ("B", "Ops")]
    left = emp.join(dept, "dept", "left")
    assert rows(left, "name", "dept_name") == [("A", "Eng"), ("B", "Ops"), ("C", None)]


def test_a6_second_and_nth_highest(spark):
    def nth(values, n):
        df = spark.createDataFrame([(v,) for v in values], "salary double")
        return rel.nth_highest(df, "salary", n).collect()[0][0]
    assert nth([100.0, 200.0, 300.0], 2) == 200.0
    assert nth([300.0, 300.0, 200.0], 2) == 200.0
    assert nth([300.0], 2) is None
    assert nth([], 2) is None
    assert nth([1.0, None, 5.0, 3.0, 5.0], 3) == 1.0


def test_f7_above_average(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, None)], "id long, v double")
    assert rows(rel.above_scalar(df, "v"), "id") == [(3,)]


def test_a3_duplicates(spark):
    p = spark.createDataFrame([(1, "a@x"), (2, "b@x"), (3, "a@x"), (4, "c@x"), (5, "b@x")], "id long, email string")
    assert rows(rel.duplicate_keys(p, "email"), "email", "n") == [("a@x", 2), ("b@x", 2)]


def test_j3_anti_join_customers_without_orders(spark):
    c = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "id long, name string")
    o = spark.createDataFrame([(10, 1, 5.0), (11, 3, 7.0), (12, 3, 1.0)], "oid long, customer_id long, amount double")
    out = joins.anti_join(c, o.select(F.col("customer_id").alias("id")), "id")
    assert rows(out, "name") == [("B",), ("D",)]


def test_f8_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right_plain = spark.createDataFrame([(2,)], "v long")
    right_null = spark.createDataFrame([(2,), (None,)], "v long")
    right_empty = spark.createDataFrame([], "v long")
    assert rows(joins.not_in(left, "k", right_plain, "v")) == [(1,)]
    assert rows(joins.not_in(left, "k", right_null, "v")) == []
    assert rows(joins.not_in(left, "k", right_empty, "v")) == [(1,), (2,), (None,)]


def test_a5_conditional_sum_missing_group_is_zero(spark):
    emp = spark.createDataFrame([(1, "M", 10.0, 1), (2, "F", 20.0, 1), (3, "F", 5.0, 2), (4, "M", 7.5, 3), (5, "M", 2.5, 3)],
                                "id long, gender string, salary double, dept long")
    out = rel.conditional_sums(emp, "dept", {"male": (F.col("gender") == "M", F.col("salary")),
                                             "female": (F.col("gender") == "F", F.col("salary"))})
    assert rows(out, "dept", "male", "female") == [(1, 10.0, 20.0), (2, 0.0, 5.0), (3, 10.0, 0.0)]


def test_w2_top3_distinct_with_ties_and_small_group(spark):
    emp = spark.createDataFrame([(1, "a", 100.0, 1), (2, "b", 90.0, 1), (3, "c", 90.0, 1), (4, "d", 80.0, 1),
                                 (5, "e", 70.0, 1), (6, "f", 50.0, 2), (7, "g", 40.0, 2)],
                                "id long, name string, salary double, dept long")
    out = win.top_n_per_group(emp, "dept", [F.col("salary").desc()], 3)
    assert rows(out, "name") == [("a",), ("b",), ("c",), ("d",), ("f",), ("g",)]


def test_w3_rising_previous_record_not_previous_day(spark):
    w = spark.createDataFrame([(1, date(2024, 1, 1), 10.0), (2, date(2024, 1, 2), 12.0), (3, date(2024, 1, 5), 11.0),
                               (4, date(2024, 1, 6), 15.0), (5, date(2024, 1, 7), 15.0)],
                              "id long, d date, temp double")
    rec = win.period_change(w, None, "d", "temp", mode="record")
    assert rows(rec.where(F.col("prev").isNotNull() & (F.col("temp") > F.col("prev"))), "id") == [(2,), (4,)]
    cal = win.period_change(w, None, "d", "temp", mode="calendar", period_step=F.date_sub("d", 1))
    # day 5 has no day-4 record: calendar mode gives NULL there
    assert rows(cal.where(F.col("prev").isNotNull() & (F.col("temp") > F.col("prev"))), "id") == [(2,), (4,)]
    assert rows(cal.where(F.col("id") == 3), "prev") == [(None,)]


def test_w5_streak_of_three_days(spark):
    logins = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (1, date(2024, 1, 2)), (1, date(2024, 1, 2)), (1, date(2024, 1, 3)),
         (2, date(2024, 1, 1)), (2, date(2024, 1, 3)), (2, date(2024, 1, 5)),
         (3, date(2024, 1, 10)), (3, date(2024, 1, 11)), (3, date(2024, 1, 13)), (3, date(2024, 1, 14)),
         (4, date(2024, 2, 1)), (4, date(2024, 2, 2)), (4, date(2024, 2, 3)), (4, date(2024, 2, 4))],
        "user_id long, day date")
    assert rows(win.streak_keys(logins, "user_id", "day", 3)) == [(1,), (4,)]
    assert rows(win.longest_streak(logins, "user_id", "day"), "user_id", "longest") == [(1, 3), (2, 1), (3, 2), (4, 4)]


def test_a4_having_both_conditions(spark):
    o = spark.createDataFrame([(1, 1, 150.0), (2, 1, 100.0), (3, 2, 10.0), (4, 2, 10.0), (5, 2, 10.0),
                               (6, 3, 90.0), (7, 3, 80.0), (8, 3, 70.0)], "oid long, cust long, amt double")
    g = o.groupBy("cust").agg(F.count(F.lit(1)).alias("n"), F.sum("amt").alias("total"))
    assert rows(g.where((F.col("n") >= 3) & (F.col("total") > 200)), "cust", "total") == [(3, 240.0)]


def test_w6_running_total_rows_frame(spark):
    s = spark.createDataFrame([(1, date(2024, 1, 1), 10.25), (2, date(2024, 1, 2), 5.5), (3, date(2024, 1, 3), 0.25)],
                              "id long, d date, rev double").withColumn("rev_d", money("rev"))
    out = win.running_total(s, None, ["d"], "rev_d")
    assert rows(out, "id", "running_total") == [(1, money_v("10.25")), (2, money_v("15.75")), (3, money_v("16.00"))]


def money_v(x):
    from decimal import Decimal
    return Decimal(x)


def test_f3_half_open_bands(spark):
    m = spark.createDataFrame([(1, 200.0), (2, 199.9), (3, 40.0), (4, 39.9), (5, None)], "id long, depth_m double")
    out = m.select("id", band("depth_m", [(200.0, "deep"), (40.0, "shelf")], "shore").alias("c"))
    assert rows(out) == [(1, "deep"), (2, "shelf"), (3, "shelf"), (4, "shore"), (5, "shore")]


def test_a2_null_aware_totals(spark):
    r = spark.createDataFrame([(1, 10.0, None), (2, None, 2.5), (3, None, None), (4, 5.005, 1.0)],
                              "id long, fare double, tip double")
    out = r.agg(F.count(F.lit(1)).alias("n"),
                round_half_up(F.sum(F.coalesce("fare", F.lit(0.0)) + F.coalesce("tip", F.lit(0.0))), 2).alias("total"),
                F.max("tip").alias("best"))
    assert rows(out) == [(4, 18.51, 2.5)]


def test_u1_union_distinct_with_null_scores(spark):
    fall = spark.createDataFrame([(1, "Al", 60), (2, "Bea", 59), (3, "Cal", None)], "id long, name string, score long")
    spring = spark.createDataFrame([(1, "Al", 70), (2, "Bea", 61), (3, "Dot", 80)], "id long, name string, score long")
    a = fall.where(F.col("score") >= 60).select("name")
    b = spring.where(F.col("score") >= 60).select("name")
    assert rows(rel.union_distinct(a, b)) == [("Al",), ("Bea",), ("Dot",)]
    assert rows(rel.except_distinct(b, a)) == [("Bea",), ("Dot",)]


def test_f4_coalesce_default(spark):
    e = spark.createDataFrame([(1, "A", None), (2, "B", 3.5)], "id long, name string, bonus double")
    assert rows(rel.fill_defaults(e, {"bonus": 0.0}), "name", "bonus") == [("A", 0.0), ("B", 3.5)]


def test_w4_monthly_drops_per_show(spark):
    s = spark.createDataFrame([(1, "2024-01", 100), (1, "2024-02", 80), (1, "2024-04", 90), (1, "2024-05", 90),
                               (2, "2024-01", 5), (2, "2024-02", 4)], "show long, month string, streams long")
    out = win.period_change(s, "show", "month", "streams", prev="prev")
    drops = out.where(F.col("prev").isNotNull() & (F.col("streams") < F.col("prev")))
    assert rows(drops, "show", "month", "streams", "prev") == [(1, "2024-02", 80, 100), (2, "2024-02", 4, 5)]


def test_w8_ticket_number_runs(spark):
    tickets = spark.createDataFrame(
        [(1, 1, 101, 0), (2, 1, 102, 0), (3, 1, 103, 1), (4, 1, 104, 0), (5, 1, 105, 0), (6, 1, 107, 0),
         (7, 2, 200, 0), (8, 3, 300, 1), (9, 3, 301, 1), (10, 4, 50, 0), (11, 4, 51, 0), (12, 4, 51, 0)],
        "id long, reel long, ticket long, torn long")
    valid = tickets.where(F.col("torn") == 0)
    out = win.islands(valid, "reel", "ticket", start="s", end="e", size="n")
    # reel 4: the duplicated 51 splits the run the way ROW_NUMBER does
    assert rows(out, "reel", "s", "e", "n") == [(1, 101, 102, 2), (1, 104, 105, 2), (1, 107, 107, 1),
                                                   (2, 200, 200, 1), (4, 50, 51, 2), (4, 51, 51, 1)]
    dedup = win.islands(valid, "reel", "ticket", dedupe=True, start="s", end="e", size="n")
    assert rows(dedup.where(F.col("reel") == 4), "s", "e", "n") == [(50, 51, 2)]


def test_w1_three_ranks(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 1, 20.0), (3, 1, 20.0), (4, 1, 5.0), (5, 2, 1.0)],
                               "id long, g long, v double")
    out = win.rank_columns(df, "g", "v", "id")
    assert rows(out, "id", "row_number", "rank", "dense_rank") == [
        (1, 3, 3, 2), (2, 1, 1, 1), (3, 2, 1, 1), (4, 4, 4, 3), (5, 1, 1, 1)]


def test_a7_exact_percentiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 5.0), ("b", 5.0), ("b", 9.0)],
                               "g string, v double")
    med = rel.exact_percentile(df, "g", "v", 0.5, name="m")
    assert rows(med, "g", "m") == [("a", 2.5), ("b", 5.0)]
    p9 = rel.exact_percentile(df, "g", "v", 0.9, method="disc", name="p")
    assert rows(p9, "g", "p") == [("a", 4.0), ("b", 9.0)]


def test_w11_cohorts(spark):
    ev = spark.createDataFrame([(1, date(2024, 1, 5)), (1, date(2024, 3, 1)), (2, date(2024, 1, 9)),
                                (2, date(2024, 2, 2)), (3, date(2024, 2, 20)), (3, date(2024, 2, 21))],
                               "u long, d date")
    out = win.cohort_retention(ev, "u", win.month_number("d"))
    out = out.select(win.month_of_number("cohort").alias("c"), "offset", "users")
    assert rows(out) == [("2024-01", 0, 2), ("2024-01", 1, 1), ("2024-01", 2, 1), ("2024-02", 0, 1)]


def test_o4_tie_audit(spark):
    straddle = spark.createDataFrame([(10.0,), (9.0,), (9.0,), (8.0,)], "v double")
    above = spark.createDataFrame([(10.0,), (10.0,), (9.0,), (8.0,)], "v double")
    unique = spark.createDataFrame([(10.0,), (9.0,), (8.0,)], "v double")
    amb = lambda df: rel.tie_audit(df, "v", 2).collect()[0]["ambiguous"]
    assert amb(straddle) is True
    assert amb(above) is False
    assert amb(unique) is False
