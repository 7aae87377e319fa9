"""Null keys and values keep their rows; publishing twice replaces; no size changes a schema."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarry.functions.expr import round_half_up
from quarry.operators import lifecycle as lc
from quarry.operators import quality as q
from quarry.operators import relational as rel
from quarry.operators import similarity as sim
from quarry.operators import windows as win
from quarry.operators.scan import ordered_scan


def test_ranks_keep_null_keys_and_values(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, 7), (4, None, 7), (5, "a", 9)], "id long, k string, v long")
    out = win.rank_columns(df, "k", "v", "id")
    assert rows(out, "id", "row_number", "rank", "dense_rank") == [(1, 2, 2, 2), (2, 3, 3, 3), (3, 1, 1, 1), (4, 2, 1, 1), (5, 1, 1, 1)]


def test_percentile_keeps_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert rows(rel.exact_percentile(df, "k", "v", 0.5, name="m"), "k", "m") == [("a", 5.0), (None, 2.0)]


def test_tie_audit_sees_nulls_where_top_k_puts_them(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,)], "v long")
    r = rel.tie_audit(df, "v", 1, descending=False).first()
    assert (r["better"], r["at_kth"], r["ambiguous"]) == (0, 2, True)
    r = rel.tie_audit(df, "v", 3, descending=True).first()
    assert (r["better"], r["at_kth"], r["ambiguous"]) == (2, 2, True)
    assert rel.tie_audit(df, "v", 9).first()["ambiguous"] is False


def test_publishing_again_replaces(spark, tmp_path):
    path = str(tmp_path / "final")
    for n in (2, 3):
        out = lc.publish_if_clean(spark.range(n), path, {"keys": lambda d: q.key_audit(d, "id")}, staging_path=str(tmp_path / f"s{n}"))
        assert out.first()["promoted"] is True
        assert spark.read.parquet(path).count() == n


def test_a_changed_attribute_is_a_change(spark):
    a = spark.createDataFrame([(1, "x", "u1")], "id long, sha256 string, url string")
    b = spark.createDataFrame([(1, "x", "u2")], "id long, sha256 string, url string")
    assert lc.next_version(a, b, 4).first()["version"] == 5


def test_ids_start_at_one(spark):
    empty = spark.createDataFrame([], "id long")
    out = lc.assign_ids(spark.createDataFrame([("b",), ("a",)], "t string"), empty.select(F.max("id")).scalar(), ["t"])
    assert rows(out, "t", "new_id") == [("a", 1), ("b", 2)]


def test_rounding_of_huge_numbers(spark):
    df = spark.createDataFrame([(1e40,), (1.005,), (None,)], "v double")
    assert [r[0] for r in df.select(round_half_up("v", 2)).collect()] == [1e40, 1.01, None]


def test_scan_types_do_not_depend_on_size(spark):
    df = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.col("id").cast("decimal(18,2)").alias("v"))
    one, many = (ordered_scan(df, "k", "o", sums=["v"], lag_cols=["v"], rows_per_block=n) for n in (1000, 8))
    assert sorted(one.dtypes) == sorted(many.dtypes)
    assert rows(one, "o", "run_v", "_rn", "prev_v") == rows(many, "o", "run_v", "_rn", "prev_v")


def test_similarity_threshold_outside_the_proved_range(spark):
    df = spark.createDataFrame([(1, "abcde")], "id long, t string")
    with pytest.raises(ValueError):
        sim.near_duplicates(df, "id", "t", t=0.6)
