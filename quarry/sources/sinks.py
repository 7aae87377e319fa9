"""Sinks (inventory S5, S7; S6 is ``lifecycle.write_if_changed``).

Writes are partitioned by a low-cardinality column so readers prune folders,
and every write targets a fresh folder (``errorifexists``) so a retried job
never mixes two runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.lifecycle import ledger


def write_documents(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    fmt: str = "json") -> None:
    """Document sink (S5): UTF-8 JSON lines (or Parquet), one record per id,
    partitioned by the given columns."""
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_run_report(screened: DataFrame, path: str, reason: str = "reason",
                     by: Sequence[str] = ()) -> DataFrame:
    """Run report (S7): every item below ``path/items/outcome=accepted`` or
    ``=rejected``, written in one pass over the screen, and the ledger with its
    counts, taken from what was written. Returns the ledger read back."""
    spark = screened.sparkSession
    root = path.rstrip("/")
    outcome = F.when(screened[reason].isNull(), "accepted").otherwise("rejected")
    screened.withColumn("outcome", outcome).write.mode("errorifexists").partitionBy("outcome").parquet(f"{root}/items")
    items = spark.read.schema(screened.withColumn("outcome", outcome).schema).parquet(f"{root}/items").drop("outcome")
    ledger(items, reason, by).write.mode("errorifexists").parquet(f"{root}/ledger")
    return spark.read.parquet(f"{root}/ledger")
