"""Parquet table access for the driver's test tables.

Every read goes through ``spark.read.parquet`` so that Catalyst can prune
columns and push filters into the scan; nothing here selects columns early by
hand, because the optimizer does it for whatever the query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor directory.

    ``t = Tables(spark, sf_dir); t.lineitem`` returns a fresh DataFrame over the
    Parquet file; reading is lazy, so unused tables cost nothing.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        """Register every table as a temp view (for the SQL forms)."""
        for name in TABLE_NAMES:
            read_table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
