"""Lineage cuts: tables written under the session's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The copy outlives any executor, cuts the lineage, and gives a later join an
    exchange of its own on this side, so that AQE can split a hot key there.
    """
    spark: SparkSession = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame) -> None:
    """Delete the files of a materialised table that no later step reads."""
    spark: SparkSession = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
