"""Session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames. These helpers exist for tests, the bench and the entry module, and
for the one cluster-level setting some operators need (a reliable checkpoint
directory).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "quarry", cpus: int | str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the test data and oracle rely on.

    * UTC session zone (the Parquet timestamps are zone-less).
    * AQE on: coalesces small shuffles, switches joins to broadcast when the
      runtime size is under the threshold, splits skewed join partitions.
    * UI off: no server is started.
    """
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS, S3,
    ...); it is read from the session. Only a local-mode session without the
    setting (tests, the bench) gets a fresh scratch folder; a cluster session
    without it is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; operators that cut lineage need a "
            "shared checkpoint folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the checkpoint directory and read it back: computed
    once (a ``checkpoint()`` computes its rows twice), shared by all executors,
    and an exchange of its own in later joins, so that AQE can split it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quarry-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
