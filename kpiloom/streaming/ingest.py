"""Structured Streaming ingestion that yields the batch job's rows.

* CSV drops, whose headers drift: the stream is that of the file names
  (``read_csv_drops``).  Each micro-batch resolves the headers of its own files and
  reads them in one scan (``sources.deliveries``), so a header never seen before
  needs no restart, and an unreadable file is listed, not fatal.
* Wide Parquet drops with a fixed all-string schema are read with ``readStream``.

The same column functions, dimension joins and emission run per micro-batch.
What a micro-batch writes has a folder per epoch, which its replay overwrites;
the checkpoint lets a restarted query resume where it stopped.  ``availableNow``
processes what is present and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.clean import clean_school_id
from kpiloom.operators.columns import rename_columns
from kpiloom.operators.demographics import DemographicDims
from kpiloom.plans.wide_kpi import kpi_from_typed, typed_wide
from kpiloom.schema import KPI_SCHEMA, KPI_VALUE_COLUMNS
from kpiloom.sources.deliveries import inspect, scan


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_drops(spark: SparkSession, path: str, columns: list[str], bytes_per_trigger: str | None = None) -> DataFrame:
    """New files under ``path``; a micro-batch takes all that have arrived, or
    files up to ``bytes_per_trigger`` together (such as "100g")."""
    reader = spark.readStream.schema(string_schema(columns))
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def read_csv_drops(spark: SparkSession, root: str, glob: str = "*.csv*", files_per_trigger: int | None = None) -> DataFrame:
    """(path, length) of new files under ``root``, at any depth; their content is not read."""
    reader = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("recursiveFileLookup", True).option("pathGlobFilter", glob))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(root).select("path", "length")


def csv_kpi_ingest(files: DataFrame, headers: dict[str, list[str]], columns: list[str], dims: DemographicDims, out: str, listing: str, ckpt: str) -> None:
    """CSV drops -> KPI rows, and the table of the files taken in: path, header,
    lines, status.  ``headers``: the spellings of each column; a column that no
    file of a micro-batch has is null there."""
    def ingest(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        found = inspect(spark, [(r["path"], r["length"]) for r in batch.collect()])  # names and lengths only
        wide = rename_columns(scan(found), headers)
        wide = wide.withColumns({c: F.lit(None).cast("string") for c in columns if c not in wide.columns})
        kpi_from_typed(typed_wide(wide), dims).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        found.table.write.mode("overwrite").parquet(f"{listing}/epoch={epoch}")

    _run(files.writeStream.foreachBatch(ingest), ckpt)


def _run(writer, ckpt: str) -> None:
    q = writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_kpi_ingest(stream: DataFrame, dims: DemographicDims, out: str, ckpt: str) -> None:
    """Wide drops -> KPI rows appended to Parquet (same plan as the batch job)."""
    kpi = kpi_from_typed(typed_wide(stream), dims)
    _run(kpi.writeStream.format("parquet").option("path", out).outputMode("append"), ckpt)


def stream_group_tracker(stream: DataFrame, dims: DemographicDims, out: str, ckpt: str) -> None:
    """Running distinct (year, student_group); state holds one entry per pair."""
    kpi = kpi_from_typed(typed_wide(stream), dims)
    groups = kpi.select("year", "student_group").dropDuplicates(["year", "student_group"])
    _run(groups.writeStream.format("parquet").option("path", out).outputMode("append"), ckpt)


def stream_progress_counts(stream: DataFrame, dims: DemographicDims, out: str, ckpt: str) -> None:
    """Running KPI rows per source file.  In update mode a micro-batch hands on,
    and writes, only the files whose count has changed (``read_progress``)."""
    kpi = kpi_from_typed(typed_wide(stream), dims)
    counts = kpi.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _run(counts.writeStream.outputMode("update").foreachBatch(publish), ckpt)


def read_progress(spark: SparkSession, out: str) -> DataFrame:
    """(source_file, n_rows): the last count of each file."""
    changes = spark.read.schema("source_file string, n_rows long, epoch long").parquet(out)
    return changes.groupBy("source_file").agg(F.max_by("n_rows", "epoch").alias("n_rows"))


def stream_quarantine(stream: DataFrame, dims: DemographicDims, good_out: str, bad_out: str, ckpt: str) -> None:
    """Rows without a school id go to a quarantine table with a reason; the
    rest become KPI rows; the stream keeps going either way.  Each table has a
    folder per epoch, which a replayed micro-batch overwrites, so a failure
    between the two writes leaves no row twice."""
    def split(batch: DataFrame, epoch: int) -> None:
        bad = clean_school_id("school_code").isNull()
        batch.persist()  # read and parsed once for both writes
        (batch.filter(bad).withColumn("reject_reason", F.lit("missing_school_id"))
              .write.mode("overwrite").parquet(f"{bad_out}/epoch={epoch}"))
        kpi_from_typed(typed_wide(batch.filter(~bad)), dims).write.mode("overwrite").parquet(f"{good_out}/epoch={epoch}")
        batch.unpersist()

    _run(stream.writeStream.foreachBatch(split), ckpt)


def read_kpi_output(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([f for f in KPI_SCHEMA.fields if f.name != "last_updated"])
    return spark.read.schema(schema).parquet(path).select(*KPI_VALUE_COLUMNS)
