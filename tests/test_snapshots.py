"""Published snapshots: crashes, second writers, roll back."""

import pytest

from quarry.operators import quality as q
from quarry.operators import snapshots as s


def rows(spark, root):
    return sorted(r["k"] for r in s.read_snapshot(spark, root).collect())


def table(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def test_publish_refuse_and_roll_back(spark, tmp_path):
    root = str(tmp_path / "pub")
    checks = {"keys": lambda d: q.key_audit(d, "k")}
    with pytest.raises(FileNotFoundError):
        s.read_snapshot(spark, root)
    with pytest.raises(ValueError):
        s.roll_back(spark, root)
    assert s.publish(table(spark, 1, 2), root, checks).first()["promoted"]
    first = s.current_version(spark, root)
    s.publish(table(spark, 3), root + "/", checks)
    assert rows(spark, root) == [3]
    refused = s.publish(table(spark, 4, 4), root, checks).first()
    assert (refused["promoted"], refused["findings"], refused["version"]) == (False, 1, None) and rows(spark, root) == [3]
    assert s.roll_back(spark, root) == first and rows(spark, root) == [1, 2]
    with pytest.raises(ValueError):
        s.roll_back(spark, root)
    s.publish(table(spark, 5), root)
    assert rows(spark, root) == [5] and len(s.history(spark, root)) == 4
    assert s.roll_back(spark, root, 2) == first and rows(spark, root) == [1, 2]
    assert sorted(r["k"] for r in s.read_snapshot(spark, root, s.history(spark, root)[1]).collect()) == [3]


@pytest.mark.parametrize("step", ["write", "check", "point"])
def test_a_crash_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "pub")
    s.publish(table(spark, 1), root)

    def dies(*_):
        raise KeyboardInterrupt(step)
    checks = {"dies": dies} if step == "check" else None
    if step == "point":
        monkeypatch.setattr(s, "_point", dies)
    df = table(spark, 2)
    if step == "write":
        df = df.selectExpr("assert_true(k > 5)")
    with pytest.raises(BaseException):
        s.publish(df, root, checks)
    monkeypatch.undo()
    assert rows(spark, root) == [1]
    s.publish(table(spark, 3), root)
    assert rows(spark, root) == [3]


def test_a_second_writer_is_refused(spark, tmp_path):
    root = str(tmp_path / "pub")
    s.publish(table(spark, 1), root)
    seen = len(s.history(spark, root))
    s.publish(table(spark, 2), root, seen=seen)
    with pytest.raises(s.ConcurrentPublish):
        s.publish(table(spark, 3), root, seen=seen)
    assert rows(spark, root) == [2]
    s.publish(table(spark, 4), root)
    assert rows(spark, root) == [4]


def test_altered_parts_of_a_table_of_over_a_million_keys_are_published(spark, tmp_path):
    from quarry.plans.lifecycle_plans import m11_snapshots
    keys = [0, 101, 202, 1_000_000, 1_000_101, 1_000_202, 1_010_000]
    part = spark.createDataFrame([(k, f"name {k}", "b", "t", 1, 1.0) for k in keys],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    part.write.parquet(str(tmp_path / "part.parquet"))
    seen = {r["step"]: (r["n"], r["size"], r["names"]) for r in m11_snapshots(spark, str(tmp_path)).collect()}
    kept, added = sum(k % 89 != 0 for k in keys), sum(k % 101 == 0 for k in keys)
    assert seen["1 first"] == seen["4 rolled back"] == (7, 7, 7)
    assert [seen[s][0] for s in ("2 second", "3 refused", "5 third")] == [kept + added] * 3
