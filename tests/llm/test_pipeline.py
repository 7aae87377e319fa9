"""Queries and pipeline stages over the smallest test tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import plans, secrets
from quarry.llm.plans import held_out

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = plans.PLANS[name](spark, SF)
    res = con.execute(plans.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(res.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string"))
    docs = docs.unionByName(extra).unionByName(docs.limit(1))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "secrets", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.where("doc_id is null").count() == 3, name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    assert stages["near_dedup"](spark, docs, SF).where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    clean = stages["secrets"](spark, docs, SF)
    assert clean.count() == docs.count()
    assert secrets.scan(clean).where(F.size(F.filter("spans", lambda s: s["kind"] != "guess")) > 0).count() == 0
    assert stages["mixing"](spark, docs, SF).count() == docs.count()


def test_held_out_matches_crc(spark):
    got = spark.range(50).select("id", held_out("id", 4, 2).alias("h")).collect()
    import zlib
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)
