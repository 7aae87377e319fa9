"""Training-corpus pipeline over ``documents``: each stage calls one operator of ``quarry.llm``.

A stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and reread as the next one's docs.
All stages but the last return the columns of ``documents``. Documents without an
id pass the filtering stages that need one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import apportion, containment, ftrl, secrets, superminhash
from quarry.llm.plans import held_out
from quarry.llm.scratch import materialize
from quarry.operators.joins import broadcast_if_bounded
from quarry.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of rows not held out."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    model = ftrl.fit(docs, labels)
    verdict = ftrl.score(docs, model, carry=docs.columns)
    return verdict.where("predicted = 0").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of smallest id (then text digest), once.

    Groups are of texts, whatever their ids: rows that share an id but differ in text both stay unless one is a
    near copy. Rows equal in id and text are one document; the first by a hash of all columns stays. Documents without
    words are their own group; documents without an id stay.
    """
    found = materialize(superminhash.grouped(docs, shingle_words=5, min_percent=80, by_id=False).where("doc_id is not null"), "groups")
    first = found.where("group is not null").groupBy(F.col("group").alias("g")).agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "text_key")).alias("first")).where("c > 1")
    rows = found.join(first, F.col("group") == F.col("g"))
    own = F.struct("doc_id", "text_key")
    gone = materialize(rows.where(own != F.col("first")).select("doc_id", F.col("text_key").alias("_key")).distinct(), "gone")
    repeated = materialize(found.groupBy("doc_id", F.col("text_key").alias("_key")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "repeated")

    keyed = docs.withColumn("_key", superminhash.text_key(F.col("text")))
    left = keyed.join(superminhash.known(gone), ["doc_id", "_key"], "left_anti")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    order = Window.partitionBy("doc_id", "_key").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    some = left.join(superminhash.known(repeated), ["doc_id", "_key"], "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return left.join(superminhash.known(repeated), ["doc_id", "_key"], "left_anti").select(*docs.columns).unionByName(some.select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (80% of its 5-word shingles) go."""
    found = containment.contaminated(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(broadcast_if_bounded(materialize(found, "contaminated")), "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark and ``n_chars`` follows; all documents stay."""
    found = secrets.scan(docs, carry=docs.columns)
    text, n_chars = F.coalesce("redacted", "row.text"), F.length("redacted").cast("long")
    new = {"text": text, "n_chars": F.when(F.col("redacted").isNotNull(), n_chars).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of 150% at source weights 3, 1, 2 takes."""
    return apportion.mix_sources(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontaminate),
          ("secrets", redact_secrets), ("mixing", mix)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Rows-only: near_dedup and decontamination are tested against search over all pairs,
    toxicity by its learner's definition and planted documents, the whole run by planted cases."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
