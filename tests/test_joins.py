"""Checked broadcast: marks only proven-small sides, and the proof does not
touch every partition of a large side."""

from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_bounded


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_small_side_is_marked(spark):
    small = spark.range(50)
    big = spark.range(10_000)
    j = big.join(broadcast_if_bounded(small, 100), "id")
    assert "broadcast" in _plan(j).lower()
    assert j.count() == 50


def test_large_side_is_not_marked(spark):
    side = spark.range(500)
    out = broadcast_if_bounded(side, 100)
    assert "broadcast" not in _plan(out).lower()


def test_check_is_incremental(spark):
    sc = spark.sparkContext
    many = spark.range(0, 400_000, numPartitions=200).where(F.col("id") >= 0)
    sc.setJobGroup("bcast-check", "bcast-check")
    try:
        broadcast_if_bounded(many, 1000)
    finally:
        sc.setJobGroup("", "")
    st = sc.statusTracker()
    tasks = sum(st.getStageInfo(s).numTasks for j in st.getJobIdsForGroup("bcast-check")
                for s in st.getJobInfo(j).stageIds if st.getStageInfo(s))
    assert 0 < tasks < 50
