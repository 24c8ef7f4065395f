"""Driver tables read as Parquet (columns and filters pruned by Catalyst).

Splits come from ``spark.sql.files.maxPartitionBytes`` and the files' row
groups, shuffle partitions from AQE; nothing here depends on a table's size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
