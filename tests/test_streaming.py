"""Incremental manifest over a file stream."""

import hashlib
import os
import uuid

from quarry.operators.lifecycle import scratch_path
from quarry.streaming.manifest_stream import snapshot_versions, start_manifest_stream


def test_manifest_stream_versions_only_on_change(spark):
    src, out = scratch_path(spark, "t-src"), scratch_path(spark, "t-out")
    schema = "id long, body string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.json(f"{src}/b1")
    ck = f"{out}-ck-{uuid.uuid4().hex}"
    start_manifest_stream(spark, f"{src}/b1", schema, "id", ["body"], out, checkpoint_location=ck).awaitTermination()
    assert snapshot_versions(spark, out) == [1]
    # same content again: no new version
    spark.createDataFrame([(1, "a")], schema).write.json(f"{src}/b2")
    start_manifest_stream(spark, f"{src}/b2", schema, "id", ["body"], out,
                          checkpoint_location=ck + "2").awaitTermination()
    assert snapshot_versions(spark, out) == [1]
    # a changed and a new document: version 2 with three entries
    spark.createDataFrame([(2, "b2"), (3, "c")], schema).write.json(f"{src}/b3")
    start_manifest_stream(spark, f"{src}/b3", schema, "id", ["body"], out,
                          checkpoint_location=ck + "3").awaitTermination()
    assert snapshot_versions(spark, out) == [1, 2]
    assert spark.read.parquet(f"{out}/v=2").count() == 3


def test_newest_file_wins_and_resume_reads_new_files_only(spark, tmp_path):
    """Two versions of an id in one batch: the newer file's stays, whatever its digest. A second run with the
    same checkpoint folder takes up where the first ended."""
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    for k, (name, body) in enumerate([("b.json", "old"), ("a.json", "new")]):
        (src / name).write_text(f'{{"id":1,"body":"{body}"}}\n{{"id":{10 + k},"body":"x"}}')
        os.utime(src / name, (1_600_000_000 + 100 * k, 1_600_000_000 + 100 * k))

    def run():
        start_manifest_stream(spark, str(src), "id long, body string", "id", ["body"], out, checkpoint_location=ck).awaitTermination()
        last = snapshot_versions(spark, out)[-1]
        return last, {r["id"]: r["sha256"] for r in spark.read.parquet(f"{out}/v={last}").collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()
    assert run() == (1, {1: sha("new"), 10: sha("x"), 11: sha("x")})
    assert run()[0] == 1
    (src / "c.json").write_text('{"id":10,"body":"y"}')
    assert run() == (2, {1: sha("new"), 10: sha("y"), 11: sha("x")})
