"""Dashboard preparation over the long KPI table: latest year, heatmap cells,
pivot, stats, and file / value / suppression profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.ranking import position_within
from kpiloom.session import materialized

# Which metrics a dashboard shows.
RATE_PATTERN = "_rate"
SUSPENSION_COUNT_PATTERN = "out_of_school_suspension.*_count"
SUSPENSION_TOTAL_MARK = "total_count"


def filter_district_contains(kpi: DataFrame, needle: str) -> DataFrame:
    """Case-insensitive substring filter on district; null districts drop."""
    return kpi.filter(F.coalesce(F.lower(F.col("district")).contains(needle.lower()), F.lit(False)))


def select_metrics_regex(kpi: DataFrame) -> DataFrame:
    """Distinct dashboard metrics: every '_rate' metric plus suspension count
    metrics that are totals."""
    m = F.col("metric")
    keep = m.contains(RATE_PATTERN) | (m.rlike(SUSPENSION_COUNT_PATTERN) & m.contains(SUSPENSION_TOTAL_MARK))
    return kpi.filter(keep).select("metric").distinct()


def usable(kpi: DataFrame) -> DataFrame:
    return kpi.filter((F.col("suppressed") == "N") & F.col("value").isNotNull())


def latest_year(kpi: DataFrame, year: str | None = None) -> DataFrame:
    """Usable rows of the newest year per metric (or of ``year``)."""
    u = usable(kpi)
    if year is not None:
        return u.filter(F.col("year") == year)
    newest = u.groupBy("metric").agg(F.max("year").alias("_latest"))
    return u.join(newest, (u.metric == newest.metric) & (u.year == newest._latest), "left_semi")


def latest_cells(kpi: DataFrame, year: str | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """(metric, year, school_name, student_group, cell): the mean per (school,
    group) of the chosen year (default: the newest year with usable data, per
    metric).  The KPI rows are aggregated once into cells of every year, and the
    newest year is found among those."""
    rows = usable(kpi).filter(F.col("metric").isNotNull() & F.col("year").isNotNull()
                              & F.col("school_name").isNotNull())
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    if metrics is not None:
        rows = rows.join(metrics.select("metric"), "metric", "left_semi")
    cells = rows.groupBy("metric", "year", "school_name", "student_group").agg(F.avg("value").alias("cell"))
    if year is not None:
        return cells
    cells = materialized(cells, "heatmap-cells")
    newest = cells.groupBy("metric").agg(F.max("year").alias("_latest"))
    return cells.join(newest, (cells.metric == newest.metric) & (cells.year == newest._latest), "left_semi")


def heatmap_cells(kpi: DataFrame, year: str | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """Long heatmap: (metric, year, school_name, school_rank, student_group, value).

    Cells to 1 decimal (half-even); schools ranked per metric by the unweighted
    mean of their cells, descending, school name ascending on ties.  The mean is
    rounded to 9 decimals before ranking, so that equal means tie whatever the
    order of summation.  Cells are written once to the scratch folder; ranks and
    result read them there.
    """
    cells = materialized(latest_cells(kpi, year, metrics), "heatmap-latest")
    schools = cells.groupBy("metric", "year", "school_name").agg(F.round(F.avg("cell"), 9).alias("school_mean"))
    ranked = position_within(schools, ["metric"], [F.col("school_mean").desc(), F.col("school_name").asc()],
                             out="school_rank")
    return (cells.join(ranked.select("metric", "school_name", "school_rank", "school_mean"), ["metric", "school_name"])
                 .select("metric", "year", "school_name", "school_rank", "student_group",
                         F.bround("cell", 1).alias("value"), "cell", "school_mean"))


def heatmap_pivot(kpi: DataFrame, metric: str, groups: list[str], year: str | None = None) -> DataFrame:
    """Schools x groups matrix for one metric: a column for each of ``groups`` (the
    dimension's), and a map ``other_groups`` of the cells whose label is none of
    them, so the columns don't depend on the data."""
    cells = heatmap_cells(kpi.filter(F.col("metric") == metric), year)
    other = F.struct("student_group", "value")
    return cells.groupBy("metric", "year", "school_name", "school_rank").agg(
        *(F.max(F.when(F.col("student_group") == g, F.col("value"))).alias(g) for g in groups),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(~F.col("student_group").isin(groups), other)))).alias("other_groups"))


def heatmap_stats(cells: DataFrame) -> DataFrame:
    """Per metric: schools, groups, non-null cells, min, max, and the mean of
    the per-group means (not of the cells)."""
    per_group = cells.groupBy("metric", "year", "student_group").agg(F.avg("cell").alias("group_mean"))
    g = per_group.groupBy("metric", "year").agg(F.count(F.lit(1)).alias("total_demographics"),
                                                 F.avg("group_mean").alias("avg_value"))
    c = cells.groupBy("metric", "year").agg(F.count_distinct("school_name").alias("total_schools"),
                                            F.count("cell").alias("data_points"),
                                            F.min("cell").alias("min_value"), F.max("cell").alias("max_value"))
    return c.join(g, ["metric", "year"])


def source_profile(kpi: DataFrame, source_col: str = "source") -> DataFrame:
    """Per source: dashboard metrics, sorted years, rows, data available."""
    m = F.col("metric")
    dash = m.contains(RATE_PATTERN) | (m.rlike(SUSPENSION_COUNT_PATTERN) & m.contains(SUSPENSION_TOTAL_MARK))
    return kpi.groupBy(source_col).agg(
        F.array_join(F.sort_array(F.collect_set(F.when(dash, m))), ",").alias("rate_metrics"),
        F.array_join(F.sort_array(F.collect_set(F.col("year").cast("string"))), ",").alias("years"),
        F.count(F.lit(1)).alias("total_rows"),
        (F.count(F.lit(1)) > 0).alias("data_available"))


def value_profile(kpi: DataFrame, top: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(value range, rows per metric, top-``top`` groups by rows)."""
    rng = kpi.agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                  F.count(F.lit(1)).alias("total_rows"))
    per_metric = kpi.groupBy("metric").agg(F.count(F.lit(1)).alias("n_rows"))
    groups = (kpi.groupBy("student_group").agg(F.count(F.lit(1)).alias("n_rows"))
                 .orderBy(F.col("n_rows").desc(), F.col("student_group").asc()).limit(top))
    return rng, per_metric, groups


def suppression_profile(kpi: DataFrame) -> DataFrame:
    """Per metric: suppressed and non-suppressed row counts (explicit pivot values)."""
    return (kpi.groupBy("metric").pivot("suppressed", ["Y", "N"]).count()
               .select("metric", F.coalesce(F.col("Y"), F.lit(0)).alias("suppressed_rows"),
                       F.coalesce(F.col("N"), F.lit(0)).alias("reported_rows")))
