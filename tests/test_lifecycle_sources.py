"""Lifecycle operators and document sources on small fixtures."""

import gzip
import hashlib
import json
import os
import uuid

from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import lifecycle as lc
from quarry.operators import quality as q
from quarry.sources import documents as docs


def test_manifest_versioning(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, body string")
    m1 = lc.manifest(a, "id", ["body"])
    same = lc.next_version(m1, m1, 3).collect()[0]
    assert (same["version"], same["changed"]) == (3, False)
    b = spark.createDataFrame([(1, "x"), (2, "y2"), (3, "z")], "id long, body string")
    ch = lc.next_version(m1, lc.manifest(b, "id", ["body"]), 3).collect()[0]
    assert (ch["version"], ch["n_added"], ch["n_removed"], ch["n_changed"]) == (4, 1, 0, 1)


def test_first_seen_carried(spark):
    prev = spark.createDataFrame([(1, "2024-01-01")], "id long, added_at string").withColumn("added_at", F.to_date("added_at"))
    cur = spark.createDataFrame([(1,), (2,)], "id long")
    out = lc.carry_first_seen(cur, prev, "2024-05-05")
    assert rows(out.select("id", F.col("added_at").cast("string"))) == [(1, "2024-01-01"), (2, "2024-05-05")]


def test_assign_ids_after_max(spark):
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "title string")
    out = lc.assign_ids(new, F.lit(41), ["title"], id_col="n")
    assert rows(out) == [("a", 42), ("b", 43), ("c", 44)]


def test_quota_and_sample(spark):
    df = spark.createDataFrame([(i, "E" if i % 3 else "H") for i in range(1, 20)], "id long, cls string")
    out = lc.quota(df, "cls", [F.col("id")], 2)
    assert rows(out, "cls", "id") == [("E", 1), ("E", 2), ("H", 3), ("H", 6)]
    s1 = [r.id for r in lc.sample_without_replacement(df, "id", 5, 9).collect()]
    s2 = [r.id for r in lc.sample_without_replacement(df, "id", 5, 9).collect()]
    assert s1 == s2 and len(set(s1)) == 5
    used = spark.createDataFrame([(i,) for i in s1], "id long")
    s3 = [r.id for r in lc.sample_without_replacement(df, "id", 100, 9, used=used).collect()]
    assert len(s3) == 14 and not set(s3) & set(s1)


def test_publish_gate(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    dirty = clean.unionByName(clean.limit(1))
    checks = {"keys": lambda d: q.key_audit(d, "id")}
    root = lc.scratch_path(spark, "test-publish")
    ok = lc.publish_if_clean(clean, f"{root}/ok", checks).collect()
    bad = lc.publish_if_clean(dirty, f"{root}/bad", checks).collect()
    assert ok[0]["promoted"] is True and spark.read.parquet(f"{root}/ok").count() == 2
    assert bad[0]["promoted"] is False and bad[0]["findings"] == 1


def test_json_collection_with_bad_documents(spark, tmp_path):
    d = tmp_path / f"docs-{uuid.uuid4().hex}"
    d.mkdir()
    good = {"id": "sql_001", "title": "T", "difficulty": "EASY", "tables": [
        {"name": "E", "columns": [{"name": "id", "type": "INTEGER"}, {"name": "s", "type": "REAL"},
                                  {"name": "n", "type": "TEXT"}],
         "rows": [[1, 2.5, "a"], [2, None, "b"], ["x", 1, "c"], [3, 4.0]]}]}
    (d / "sql_001.json").write_text(json.dumps(good, indent=2))
    (d / "sql_002.json").write_text("{ not json")
    (d / "notes.txt").write_text("ignored")
    df = docs.read_json_collection(spark, str(d))
    valid, bad = docs.split_valid(df)
    assert [r.id for r in valid.collect()] == ["sql_001"]
    assert bad.count() == 1 and bad.collect()[0]["file_name"] == "sql_002.json"
    cells = docs.typed_cells(docs.inline_tables(valid))
    assert rows(cells.where(~F.col("fits")), "row_no", "col_no", "text") == [(2, 0, "x")]
    assert rows(cells.where(~F.col("arity_ok")).select("row_no").distinct()) == [(3,)]
    t = docs.typed_table(docs.inline_tables(valid), "sql_001", "E", {"id": "INTEGER", "s": "REAL", "n": "TEXT"})
    assert rows(t) == [(1, 2.5, "a"), (2, None, "b"), (3, 4.0, None), (None, 1.0, "c")]


def test_binary_digests(spark, tmp_path):
    p = tmp_path / f"bin-{uuid.uuid4().hex}"
    p.mkdir()
    (p / "a.bin").write_bytes(b"abc")
    out = docs.binary_digests(spark, str(p)).collect()
    assert out[0]["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert os.path.basename(out[0]["path"]) == "a.bin"


def test_binary_digests_stream_files_of_any_size(spark, tmp_path):
    """Files above what ``binaryFile`` gives as one content; any bytes and names; an empty file has no row."""
    p = tmp_path / f"bin-{uuid.uuid4().hex}"
    (p / "table.parquet").mkdir(parents=True)
    files = {"a b%20c.parquet": bytes(range(256)) * 4096, "d.gz": gzip.compress(os.urandom(5000)), "bom": b"\xef\xbb\xbf1\r\n\n",
             "no newline": b"\0" * 300_000, "tiny.parquet": b"\n"}
    for name, data in (files | {"empty.parquet": b"", "table.parquet/part-0.parquet": b"below"}).items():
        (p / name).write_bytes(data)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        out = docs.binary_digests(spark, str(p))
        assert rows(out) == sorted((f"file:{p / n}", len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items())
        assert out.schema.simpleString() == "struct<path:string,length:bigint,sha256:string>"
        assert rows(docs.binary_digests(spark, str(p), "*.parquet"), "length") == [(1,), (1 << 20,)]
        assert rows(out.where("sha256 LIKE '%'").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha256").alias("d"))) == [(5, 5)]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
