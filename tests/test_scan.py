"""Property test: the blocked ordered scan equals the plain window."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.scan import ordered_scan, plan_blocks

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(-50, 50))),
                min_size=0, max_size=120)


@settings(max_examples=6, deadline=None)
@given(data=ROWS, keyed=st.booleans(), rpb=st.sampled_from([3, 10, 1000]))
def test_scan_equals_window(spark, data, keyed, rpb):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "k long, o long, v long")
    keys = ["k"] if keyed else []
    got = ordered_scan(df, keys, ["o"], sums=["v"], lag_cols=["v"], rows_per_block=rpb, sample_rows=40)
    w = Window.partitionBy(*keys).orderBy("o") if keys else Window.orderBy("o")
    exp = (df.withColumn("e_run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("e_rn", F.row_number().over(w)).withColumn("e_prev", F.lag("v").over(w)))
    j = got.join(exp, "o")
    bad = j.where(~F.col("run_v").eqNullSafe(F.col("e_run")) | (F.col("_rn") != F.col("e_rn"))
                  | ~F.col("prev_v").eqNullSafe(F.col("e_prev")))
    assert got.count() == len(data)
    assert bad.count() == 0


def _expected(df, keys):
    w = Window.partitionBy(*keys).orderBy("o") if keys else Window.orderBy("o")
    return (df.withColumn("e_run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("e_rn", F.row_number().over(w)).withColumn("e_prev", F.lag("v").over(w)))


def _assert_same(got, exp, n):
    j = got.join(exp, "o")
    bad = j.where(~F.col("run_v").eqNullSafe(F.col("e_run")) | (F.col("_rn") != F.col("e_rn"))
                  | ~F.col("prev_v").eqNullSafe(F.col("e_prev")))
    assert got.count() == n
    assert bad.count() == 0


def test_hot_composite_key_is_split(spark):
    # (1, 'a') holds 60% of the rows; NULL keys and small keys around it
    data = []
    for i in range(600):
        data.append((1, "a", i, i % 7 - 3))
    for i in range(600, 1000):
        k1 = None if i % 10 == 0 else i % 5
        data.append((k1, "b" if i % 3 else None, i, None if i % 11 == 0 else i % 5))
    df = spark.createDataFrame(data, "k1 long, k2 string, o long, v long")
    planned = plan_blocks(df, ["k1", "k2"], ["o"], rows_per_block=100, sample_rows=200)
    assert planned is not None
    got = ordered_scan(df, ["k1", "k2"], ["o"], sums=["v"], lag_cols=["v"], rows_per_block=100, sample_rows=200)
    _assert_same(got, _expected(df, ["k1", "k2"]), len(data))


def test_keyless_relation_is_split(spark):
    df = spark.range(0, 5000, numPartitions=16).select(F.col("id").alias("o"), (F.col("id") % 13 - 6).alias("v"))
    planned = plan_blocks(df, [], ["o"], rows_per_block=400, sample_rows=300)
    assert planned is not None
    got = ordered_scan(df, [], ["o"], sums=["v"], lag_cols=["v"], rows_per_block=400, sample_rows=300)
    _assert_same(got, _expected(df, []), 5000)


def test_thousands_of_hot_keys(spark):
    """5,000 hot keys: same result, and a plan whose size does not depend on their number."""
    def made(n):
        return spark.range(0, 12 * n, numPartitions=8).select(
            F.col("id").alias("o"), (F.col("id") % n).alias("k"), (F.col("id") % 13 - 6).alias("v"))

    def scan(n):
        return ordered_scan(made(n), ["k"], ["o"], sums=["v"], lag_cols=["v"], rows_per_block=10)
    _assert_same(scan(5000), _expected(made(5000), ["k"]), 60_000)
    size = [len(scan(n)._jdf.queryExecution().optimizedPlan().toString()) for n in (50, 5000)]
    assert abs(size[0] - size[1]) < 0.02 * size[0]


def test_split_points_handle_null_and_text_orders(spark):
    data = [(None if i % 3 else "k", None if i % 7 == 0 else f"t{i % 50:02d}", i, i) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t string, o long, v long")
    got = ordered_scan(df, ["k"], ["t", "o"], sums=["v"], lag_cols=["v"], rows_per_block=30)
    w = Window.partitionBy("k").orderBy("t", "o")
    exp = (df.withColumn("e_run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("e_rn", F.row_number().over(w)).withColumn("e_prev", F.lag("v").over(w)).drop("k", "t", "v"))
    _assert_same(got, exp, 400)
