"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: what
    follows reads files that survive a lost executor instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_prefix(columns: list[str]) -> str:
    """Underscores with which no column begins: names that start so are free."""
    prefix = "_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Hold the Arrow batches that Python functions get to ``size``, unless the
    session was set up with a size of its own: a worker's memory then follows
    the batch, not 10,000 texts of any length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, size)
