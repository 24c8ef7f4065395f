"""Stored heatmap cells over years: sums and counts that later deliveries are added to.

A cell is (metric, year, district, school, group) with the sum and the number of
its usable values.  Each delivery keeps its own cells in the partition (year,
delivery), so storing a delivery writes the partitions of its years alone and
storing it again replaces them; nothing is counted twice.  Cells merge when they
are read: means of schools, districts and the state come out of one aggregation
of sums, never of means.

Cases: suppressed rows and rows without a value, metric, year or school are no
part of a cell; a null district or group is a value of its own; a year that a
repeated delivery no longer has keeps its old cells until ``drop_delivery``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.operators.dashboard import usable

CELL_KEY = ["metric", "district", "school_name", "student_group"]
CELLS = ("metric string, district string, school_name string, student_group string, total double, n_values bigint, year string, delivery string")
# what a level keeps of the key; the rest is rolled up
LEVELS = {"school": CELL_KEY, "district": ["metric", "district", "student_group"], "state": ["metric", "student_group"]}


def cell_sums(kpi: DataFrame) -> DataFrame:
    """(metric, district, school_name, student_group, year, total, n_values) of long KPI rows."""
    rows = usable(kpi).filter("metric IS NOT NULL AND year IS NOT NULL AND school_name IS NOT NULL")
    return rows.groupBy(*CELL_KEY, F.col("year").cast("string").alias("year")).agg(F.sum("value").alias("total"), F.count("value").alias("n_values"))


def store_cells(kpi: DataFrame, path: str, delivery: str) -> None:
    """Write the cells of a delivery; only its own partitions change."""
    cells = cell_sums(kpi).withColumn("delivery", F.lit(delivery))
    (cells.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "delivery").parquet(path))


def drop_delivery(spark: SparkSession, path: str, delivery: str) -> None:
    """Take a delivery out of all years."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*")
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(delivery)
    for st in fs.globStatus(glob) or []:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), f"delivery={name}"), True)


def stored_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELLS).parquet(path)


def series(cells: DataFrame) -> DataFrame:
    """level, metric, year, district, school_name, student_group, n_values, value, change:
    the mean of all values beneath, to 1 decimal, and its change from the year before
    that the series has.  All levels come out of one aggregation; a window holds the
    years of one series."""
    key = [*CELL_KEY, "year"]
    sets = [[c for c in key if c in (*keep, "year")] for keep in LEVELS.values()]
    rolled = cells.groupingSets(sets, *key).agg(F.grouping("school_name").alias("no_school"), F.grouping("district").alias("no_district"),
                                               F.sum("total").alias("total"), F.sum("n_values").alias("n_values"))
    level = F.when(F.col("no_school") == 0, "school").when(F.col("no_district") == 0, "district").otherwise("state")
    own = rolled.select(level.alias("level"), *CELL_KEY, "year", "n_values", F.bround(F.round(F.col("total") / F.col("n_values"), 9), 1).alias("value"))
    before = F.lag("value").over(Window.partitionBy("level", *CELL_KEY).orderBy("year"))
    return own.withColumn("change", F.round(F.col("value") - before, 1))
