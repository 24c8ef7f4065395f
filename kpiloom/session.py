"""Session construction and the shared scratch location.

Only tests and the bench build their own session; library code always takes
the caller's ``SparkSession``.  Intermediate tables that must survive executor
loss are written under ``spark.checkpoint.dir`` (a shared folder on a cluster).
Where that setting is absent, a private folder is made in local mode (tests);
on any other master this is an error, since executors could not see it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "kpiloom") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or f"local[{cpus}]")
    parts = shuffle_partitions or int(cpus) * 2
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("KPILOOM_DRIVER_MEMORY", "16g"),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a private one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="kpiloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, below the application's own."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/kpiloom/{spark.sparkContext.applicationId}"


# HotSpot leaves methods of more bytecode than this to its interpreter; partitions that
# a task writes at once (beyond them, its rows are sorted by partition).
WRITER_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "32"}


@contextmanager
def writer_settings(spark: SparkSession) -> Iterator[None]:
    """While a wide table is converted and written: a stage whose generated code is
    larger than the JVM compiles runs operator by operator, and rows are not
    sorted by partition first.  The session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in WRITER_SETTINGS}
    for k, v in WRITER_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialized(df: DataFrame, name: str, together: list[str] | None = None) -> DataFrame:
    """``df`` written once to the scratch folder and read back: several readers
    share it, and it survives lost executors.  ``together``: columns whose equal
    rows lie in the same files, split over several where they are many."""
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance", *together) if together else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders, not those of others that share
    the checkpoint root; call it once the results built from them have been written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
