"""Moving averages over blocks with a halo, and quantile sketches, against plain Python."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import windows as win


def mean(values):
    some = [v for v in values if v is not None]
    return round(float(sum(some)) / len(some), 9) if some else None


@pytest.mark.parametrize("rows,block", [(7, 1_000_000), (7, 10), (7, 3), (1, 5), (25, 4)])
def test_rows_frame(spark, rows, block):
    r = random.Random(rows)
    data = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 5}", i, None if r.random() < 0.2 else Decimal(r.randint(-500, 500)) / 4) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o long, v decimal(12,2)")
    for keys in (["k"], []):
        by = {}
        want = {}
        for k, o, v in data:
            own = by.setdefault(k if keys else 0, [])
            own.append(v)
            want[o] = mean(own[-rows:])
        out = win.moving_average(df, keys, ["o"], "v", rows=rows, rows_per_block=block)
        got = {x["o"]: None if x["moving_avg"] is None else round(float(x["moving_avg"]), 9) for x in out.collect()}
        assert got.keys() == want.keys() and all(got[o] == pytest.approx(want[o], abs=1e-5) for o in want)
        assert out.columns == [*df.columns, "moving_avg"]


@pytest.mark.parametrize("days,block", [(7, 4096), (7, 10), (30, 7), (1, 5)])
def test_range_frame(spark, days, block):
    r = random.Random(days)
    start = datetime.date(1969, 11, 20)
    data = sorted({(r.choice(["a", "b", None]), start + datetime.timedelta(r.randint(0, 120))) for _ in range(150)}, key=str)
    data = [(k, d, r.choice([None, 1.5, 2.25, -4.0])) for k, d in data] + [("a", None, 1.0)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    got = {(x["k"], x["d"]): x["moving_avg_days"] for x in win.calendar_moving_average(df, "k", "d", "v", days=days, days_per_block=block).collect()}
    assert len(got) == len(data)
    for k, d, _ in data:
        near = [v for k2, d2, v in data if k2 == k and d is not None and d2 is not None and 0 <= (d - d2).days < days and v is not None]
        assert got[(k, d)] == (pytest.approx(sum(near) / len(near)) if near else None)


def test_frame_plans_have_no_join(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.col("id").cast("decimal(10,2)").alias("v"),
                                  F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    for out in (win.moving_average(df, "k", ["o"], "v"), win.calendar_moving_average(df, "k", "d", "v")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange") == 1


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("g"),
                                    F.when(F.col("id") % 10 != 0, F.sqrt(F.col("id").cast("double"))).alias("x"))
    parts = rel.quantile_sketches(df, ["g", "day"], "x")
    whole = rel.sketch_percentiles(rel.merge_sketches(parts, "g"), [(0.5, "p50"), (0.99, "p99")])
    values = {}
    for x in df.where("x is not null").collect():
        values.setdefault(x["g"], []).append(x["x"])
    got = {r["g"]: r for r in whole.collect()}
    assert got.keys() == values.keys()
    for g, own in values.items():
        own.sort()
        for p, c in ((0.5, "p50"), (0.99, "p99")):
            below = sum(v < got[g][c] for v in own) / len(own)
            assert abs(below - p) <= rel.SKETCH_ERROR
    assert max(len(r["sketch"]) for r in rel.merge_sketches(parts, "g").collect()) < 40_000


def test_global_percentiles_read_the_table_once(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 37)
    out = rel.exact_percentiles(df, None, "x", [(0.5, "cont", "a"), (0.9, "disc", "b")])
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(out.first()) == (18.0, 33)
    assert tuple(rel.exact_percentiles(df.where("false"), None, "x", [(0.5, "cont", "a")]).first()) == (None,)
