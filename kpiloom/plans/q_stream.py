"""Streaming ingestion equal to the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_normalize import W_SOURCE_HEADERS
from kpiloom.plans.q_sources import write_wide_deliveries
from kpiloom.plans.registry import register
from kpiloom.session import scratch_path
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables
from kpiloom.streaming import ingest as ST

W_COLUMNS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic", "suppressed",
             "total_count", "a_count", "n_count", "r_count", "qty_text", "r_rate"]


def write_drops(spark, sf, quarantine: bool = False) -> str:
    """W as Parquet drops, rows of a school year together, large years in several files."""
    root = scratch_path(spark, "wide-drops")
    w = fixtures.wide(Tables(spark, sf))
    if quarantine:
        w = w.withColumn("school_code", F.when(F.col("school_code").cast("bigint") % 11 == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("school_code")))
    w.select(*W_COLUMNS).hint("rebalance", "school_year").write.parquet(root)
    return root


@register("stream_kpi_ingest", ctes("fx_k") + "SELECT * FROM fx_k")
def stream_kpi_ingest_q(spark, sf):
    """CSV drops with two headers, a micro-batch of some files at a time."""
    src = write_wide_deliveries(spark, sf)
    out, listing, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("kpi", "listing", "kpi-ckpt"))
    ST.csv_kpi_ingest(ST.read_csv_drops(spark, src, files_per_trigger=16), W_SOURCE_HEADERS, W_COLUMNS, W_DIMS, out, listing, ckpt)
    return ST.read_kpi_output(spark, out)


@register("stream_group_tracker", ctes("fx_k") + "SELECT DISTINCT year, student_group FROM fx_k")
def stream_group_tracker_q(spark, sf):
    src = write_drops(spark, sf)
    out, ckpt = scratch_path(spark, "stream-groups"), scratch_path(spark, "stream-groups-ckpt")
    ST.stream_group_tracker(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    return spark.read.parquet(out).select("year", "student_group")


@register("stream_progress_counts", ctes("fx_k") + "SELECT source_file, count(*) AS n_rows FROM fx_k GROUP BY source_file")
def stream_progress_counts_q(spark, sf):
    src = write_drops(spark, sf)
    out, ckpt = scratch_path(spark, "stream-counts"), scratch_path(spark, "stream-counts-ckpt")
    ST.stream_progress_counts(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    return ST.read_progress(spark, out)


@register("stream_quarantine", ctes("fx_w") + "SELECT school_year, school_name, demographic, 'missing_school_id' AS reject_reason "
          "FROM fx_w WHERE CAST(school_code AS BIGINT) % 11 = 0")
def stream_quarantine_q(spark, sf):
    src = write_drops(spark, sf, quarantine=True)
    good, bad, ckpt = (scratch_path(spark, "stream-good"), scratch_path(spark, "stream-bad"),
                       scratch_path(spark, "stream-quarantine-ckpt"))
    ST.stream_quarantine(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, good, bad, ckpt)
    return spark.read.parquet(bad).select("school_year", "school_name", "demographic", "reject_reason")
