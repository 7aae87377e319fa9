"""Property test: the salted two-phase top-N equals the plain window."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import windows as W
from quarry.operators.relational import nth_highest

# a hot key (0) holds most rows; values repeat, so ranks tie
ROWS = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 12)), min_size=0, max_size=150)


@settings(max_examples=8, deadline=None)
@given(data=ROWS, kind=st.sampled_from(["dense_rank", "rank", "row_number"]), n=st.integers(1, 9),
       salts=st.sampled_from([1, 3, 16]))
def test_salted_top_n_equals_window(spark, data, kind, n, salts):
    saved, W.GROUP_LIMIT_THRESHOLD = W.GROUP_LIMIT_THRESHOLD, 0  # force the salted form
    try:
        _check(spark, data, kind, n, salts)
    finally:
        W.GROUP_LIMIT_THRESHOLD = saved


def _check(spark, data, kind, n, salts):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k long, v long, i long")
    order = [F.col("v").desc(), F.col("i").asc()] if kind == "row_number" else [F.col("v").desc()]
    got = W.top_n_per_group(df, "k", order, n, kind=kind, salts=salts)
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
    exp = df.withColumn("rnk", fn().over(Window.partitionBy("k").orderBy(*order))).where(F.col("rnk") <= n)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_nth_highest_salted(spark, monkeypatch):
    monkeypatch.setattr(W, "GROUP_LIMIT_THRESHOLD", 0)
    df = spark.createDataFrame([(v,) for v in [5, 9, 9, 7, None, 3, 7, 1]], "v long")
    assert nth_highest(df, "v", 3).collect()[0][0] == 5
    assert nth_highest(df, "v", 6).collect()[0][0] is None


VALS = st.lists(st.tuples(st.sampled_from([None, 0, 0, 0, 1, 2]), st.one_of(st.none(), st.integers(0, 6))),
                min_size=0, max_size=150)


@settings(max_examples=8, deadline=None)
@given(data=VALS, kind=st.sampled_from(["dense_rank", "rank"]), n=st.integers(1, 5), desc=st.booleans())
def test_top_n_values_equals_window(spark, data, kind, n, desc):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k long, v long, i long")
    got = W.top_n_values(df, "k", "v", n, kind=kind, descending=desc)
    fn = {"dense_rank": F.dense_rank, "rank": F.rank}[kind]
    o = F.col("v").desc() if desc else F.col("v").asc()
    exp = df.withColumn("rnk", fn().over(Window.partitionBy("k").orderBy(o))).where(F.col("rnk") <= n)
    assert sorted(map(tuple, got.select("k", "v", "i", "rnk").collect()), key=str) == \
        sorted(map(tuple, exp.select("k", "v", "i", "rnk").collect()), key=str)
