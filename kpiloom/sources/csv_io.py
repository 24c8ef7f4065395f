"""CSV deliveries: scan with drifting headers, provenance, allowlists, format labels,
and the KPI / heatmap sinks.

A folder of exports whose headers drift cannot be read with one
``spark.read.csv``: the first file's header would be applied by position to
every file.  ``sources.deliveries`` resolves each file's header on the executors
and reads all files in one scan.  0-byte files are listed as empty; header-only
files yield no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.schema import KPI_SCHEMA, KPI_VALUE_COLUMNS, select_kpi_columns
from kpiloom.session import writer_settings
from kpiloom.sources.deliveries import Deliveries, UnreadableFiles, inspect, list_files, scan


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def scan_raw_csv(spark: SparkSession, pattern: str, allow: list[str] | None = None,
                 deliveries: Deliveries | None = None, multi_line: bool = False) -> DataFrame:
    """Every CSV under ``pattern`` as all-string columns (header names kept,
    repeated names numbered), plus ``_source_path``, ``_source_header`` (the
    names in the file's header) and ``_corrupt`` (the raw line where its number
    of fields is not the header's, else null), in one scan (``sources.deliveries``).

    ``multi_line``: fields may hold line breaks inside quotes; such files are
    not split, so it is a choice per source.  A file that can't be read to its end
    raises, unless the caller passes the ``deliveries`` (``inspect_csv``) whose
    table names it; then it is left out whole and the others count."""
    if deliveries is None:
        deliveries = inspect_csv(spark, pattern, allow)
        if deliveries.unreadable:
            raise UnreadableFiles(f"files that could not be read: {', '.join(sorted(deliveries.unreadable))}")
    return scan(deliveries, multi_line)


def inspect_csv(spark: SparkSession, pattern: str, allow: list[str] | None = None) -> Deliveries:
    """The files of ``pattern``, optionally those matching one of the ``allow``
    globs, each read once to its end: header, lines, status."""
    return inspect(spark, list_files(spark, pattern, allow))


def source_file_column(path_col: Column | str = "_source_path", level: str = "file") -> Column:
    """Provenance: the file name, or (for Spark-written deliveries) the name of
    the delivery folder that holds the part files."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    if level == "folder":
        return F.regexp_extract(p, r"([^/=]+)/[^/]+$", 1)
    return F.regexp_extract(p, r"([^/]+)$", 1)


# File-type labels by name fragments (lower-cased name).
FILE_TYPES = [("index_scores", "index_scores"), ("survey_results", "survey_results"),
              ("precautionary", "precautionary_measures"), ("accountability_profile", "accountability_profile")]


def classify_file(name: Column | str) -> Column:
    n = F.lower(F.col(name) if isinstance(name, str) else name)
    out = None
    for frag, label in FILE_TYPES:
        out = F.when(n.contains(frag), F.lit(label)) if out is None else out.when(n.contains(frag), F.lit(label))
    qc = n.contains("quality_of_school_climate")
    return (out.when(qc & n.contains("index"), F.lit("survey_index_scores"))
               .when(qc, F.lit("survey_responses")).otherwise(F.lit("unknown")))


def detect_format(df: DataFrame, rules: list[tuple[str, list[str]]], out: str = "data_format",
                  header: str = "_source_header") -> DataFrame:
    """Label each row by the columns of its file's header, whatever the row's
    cells: the first rule whose columns all stand in the header wins."""
    label = F.lit("unknown_format")
    for name, cols in reversed(rules):
        cond = reduce(lambda a, b: a & b, [F.array_contains(header, c) for c in cols])
        label = F.when(cond, F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def sink_kpi(kpi: DataFrame, path: str, source: str, mode: str = "overwrite", by_year: bool = False) -> None:
    """KPI rows, all 19 columns, as Parquet partitioned by (source, year);
    dynamic partition overwrite, an option of the writer whatever the session says,
    replaces only the partitions written.  Rows of a
    year are brought together by a rebalance, which splits large years over
    several tasks and files (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    ``by_year``: the rows come from a stored table whose rows of a year lie
    together, so they are written as they are converted."""
    rows = (select_kpi_columns(kpi, with_timestamp=True).withColumn("last_updated", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .withColumn("source", F.lit(source)))
    with writer_settings(kpi.sparkSession):
        ((rows if by_year else rows.hint("rebalance", "year"))
            .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("source", "year").parquet(path))


def read_kpi(spark: SparkSession, path: str) -> DataFrame:
    """Read a KPI table back in schema order (partition values stay strings)."""
    schema = T.StructType([*KPI_SCHEMA.fields, T.StructField("source", T.StringType())])
    return spark.read.schema(schema).parquet(path).select(*KPI_VALUE_COLUMNS, "source")


def sink_heatmap_json(cells: DataFrame, stats: DataFrame, path: str, source: str, metrics: DataFrame | None = None) -> None:
    """Heatmap as JSON lines under source=/metric= folders: one line per
    (metric, school) with its ordered cells (kind ``school``), one per metric
    with its stats (``stats``), and one for each of ``metrics`` that has no cell
    (``empty``).  No line grows with the number of schools.  Lines of a metric are
    brought together by a rebalance, so a task writes few files; only the
    (source, metric) folders written are replaced."""
    row = (cells.groupBy("metric", "year", "school_name", "school_rank")
                .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("student_group", "value")))).alias("values")))
    lines = row.select("metric", F.to_json(F.struct(F.lit("school").alias("kind"), "metric", "year", "school_name", "school_rank", "values")).alias("value"))
    lines = lines.unionByName(stats.select("metric", F.to_json(F.struct(F.lit("stats").alias("kind"), *stats.columns)).alias("value")))
    if metrics is not None:
        empty = metrics.select("metric").distinct().join(stats.select("metric"), "metric", "left_anti")
        error = F.lit("No data available for this metric").alias("error")
        lines = lines.unionByName(empty.select("metric", F.to_json(F.struct(F.lit("empty").alias("kind"), "metric", error)).alias("value")))
    (lines.withColumn("source", F.lit(source)).hint("rebalance", "metric")
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "metric").text(path))


HEATMAP_LINE = ("kind string, year string, school_name string, school_rank bigint, values map<string, double>, total_schools bigint, "
                "total_demographics bigint, data_points bigint, min_value double, max_value double, avg_value double, error string")


def read_heatmap_json(spark: SparkSession, path: str) -> DataFrame:
    """The lines of ``sink_heatmap_json`` as columns, one row a cell, a stats line or an empty metric."""
    line = F.from_json("value", HEATMAP_LINE).alias("line")
    rows = spark.read.text(path).select("source", "metric", line).select("source", "metric", "line.*")
    return rows.select("*", F.explode_outer("values").alias("student_group", "value")).drop("values")
