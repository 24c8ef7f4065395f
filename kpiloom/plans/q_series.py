"""Time series of heatmap cells, over cells stored by two deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.plans.oracle_fixtures import ctes, define
from kpiloom.plans.q_analytics import kpi_long, with_second_delivery
from kpiloom.plans.registry import register
from kpiloom.session import materialized, scratch_path
from kpiloom.sources import cells
from kpiloom.sources.tables import Tables

define("ts_rows", "SELECT * FROM kk2 WHERE suppressed = 'N' AND value IS NOT NULL AND metric IS NOT NULL AND year IS NOT NULL AND school_name IS NOT NULL", ["kk2"])
define("ts", """
SELECT 'school' AS level, metric, district, school_name, student_group, year, count(value) AS n_values, avg(value) AS mean FROM ts_rows
 GROUP BY metric, district, school_name, student_group, year
UNION ALL SELECT 'district', metric, district, NULL, student_group, year, count(value), avg(value) FROM ts_rows GROUP BY metric, district, student_group, year
UNION ALL SELECT 'state', metric, NULL, NULL, student_group, year, count(value), avg(value) FROM ts_rows GROUP BY metric, student_group, year""", ["ts_rows"])
define("ts_one", "SELECT level, metric, district, school_name, student_group, year, n_values, round_even(round(mean, 9), 1) AS value FROM ts", ["ts"])


@register("heatmap_series", ctes("ts_one") + """SELECT *, round(value - lag(value) OVER (
 PARTITION BY level, metric, district, school_name, student_group ORDER BY year), 1) AS change FROM ts_one""")
def heatmap_series_q(spark, sf):
    kpi = materialized(with_second_delivery(kpi_long(Tables(spark, sf))), "series-deliveries")
    path = scratch_path(spark, "cells")
    second = F.coalesce(F.col("source_file").startswith("z_"), F.lit(False))
    cells.store_cells(kpi.filter(~second), path, "first")
    cells.store_cells(kpi.filter(second), path, "second")
    return cells.series(cells.stored_cells(spark, path))
