"""File sources and sinks over CSV / Parquet deliveries written from the
fixtures (SURVEY 2.1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.operators import columns as COL
from kpiloom.operators import dashboard as DB
from kpiloom.plans import q_analytics  # noqa: F401  (defines the heatmap CTEs)
from kpiloom.plans import sqltext as S
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_normalize import W_HEADERS_NEW, W_HEADERS_OLD, W_SOURCE_HEADERS
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import kpi_long
from kpiloom.session import materialized, scratch_path
from kpiloom.sources import csv_io as IO
from kpiloom.sources import fixtures
from kpiloom.sources.local import local_table
from kpiloom.sources.tables import Tables

W_COLS = list(W_HEADERS_NEW)
CSV_OPTS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def touch(spark, path: str) -> None:
    """A 0-byte file (an empty export) through the Hadoop file system API."""
    fs, p, _ = IO._fs(spark, path)
    fs.create(p, True).close()


def write_wide_deliveries(spark, sf: str) -> str:
    """W as CSV deliveries, one folder per school year; years before 1998 use
    the historical headers; plus one 0-byte export."""
    root = scratch_path(spark, "wide-csv")
    w = fixtures.wide(Tables(spark, sf))
    year = F.substring("school_year", 5, 4)
    delivery = F.concat(F.lit("wide_"), year, F.lit(".csv"))
    for old, headers in ((True, W_HEADERS_OLD), (False, W_HEADERS_NEW)):
        part = w.filter((year < "1998") if old else (year >= "1998"))
        part = part.select(*[F.col(k).alias(v) for k, v in headers.items()], delivery.alias("delivery"))
        (part.hint("rebalance", "delivery").write.mode("append").options(**CSV_OPTS)
             .partitionBy("delivery").csv(root))
    touch(spark, f"{root}/delivery=wide_empty.csv/part-00000.csv")
    return root


def scanned_wide(spark, sf, allow=None):
    root = write_wide_deliveries(spark, sf)
    raw = IO.scan_raw_csv(spark, f"{root}/*/*.csv", allow=allow)
    return raw


@register("scan_raw_csv", ctes("fx_w") + "SELECT *, 'wide_' || substr(school_year, 5, 4) || '.csv' AS source_file FROM fx_w")
def scan_raw_csv_q(spark, sf):
    raw = scanned_wide(spark, sf)
    canon = COL.rename_columns(raw, W_SOURCE_HEADERS)
    return canon.select(*W_COLS, IO.source_file_column("_source_path", "folder").alias("source_file"))


@register("source_file_column", ctes("fx_w") + "SELECT 'wide_' || substr(school_year, 5, 4) || '.csv' AS source_file, "
          "count(*) AS n_rows FROM fx_w GROUP BY 1")
def source_file_column_q(spark, sf):
    raw = scanned_wide(spark, sf)
    return raw.groupBy(IO.source_file_column("_source_path", "folder").alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"))


ALLOW = ["*/delivery=wide_1997.csv/*", "*/delivery=wide_1998.csv/*", "*/delivery=wide_1999.csv/*"]


@register("scan_allowlist", ctes("fx_w") + "SELECT 'wide_' || substr(school_year, 5, 4) || '.csv' AS source_file, count(*) AS n_rows "
          "FROM fx_w WHERE substr(school_year, 5, 4) IN ('1997', '1998', '1999') GROUP BY 1")
def scan_allowlist_q(spark, sf):
    raw = scanned_wide(spark, sf, allow=ALLOW)
    return raw.groupBy(IO.source_file_column("_source_path", "folder").alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"))


# Fixed values (fixture): export name stems, one per school number modulo 7.
FILE_STEMS = ["acct_index_scores", "acct_survey_results", "safe_precautionary_measures", "accountability_profile",
              "quality_of_school_climate_index", "quality_of_school_climate_responses", "other_export"]
_STEM_SQL = "CASE CAST(school_code AS BIGINT) % 7 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(FILE_STEMS)) + " END"


def sql_classify(n: str) -> str:
    w = " ".join(f"WHEN contains(lower({n}), '{frag}') THEN '{lab}'" for frag, lab in IO.FILE_TYPES)
    qc = f"contains(lower({n}), 'quality_of_school_climate')"
    return (f"CASE {w} WHEN {qc} AND contains(lower({n}), 'index') THEN 'survey_index_scores' "
            f"WHEN {qc} THEN 'survey_responses' ELSE 'unknown' END")


@register("classify_file", ctes("fx_w") + f"SELECT file_name, {sql_classify('file_name')} AS file_type FROM "
          f"(SELECT DISTINCT upper(substr({_STEM_SQL}, 1, 1)) || substr({_STEM_SQL}, 2) || '_' || substr(school_year, 5, 4) || '.csv' "
          "AS file_name FROM fx_w) f")
def classify_file_q(spark, sf):
    w = fixtures.wide(Tables(spark, sf))
    k = F.col("school_code").cast("bigint") % 7
    stem = None
    for i, s in enumerate(FILE_STEMS):
        stem = F.when(k == i, F.lit(s)) if stem is None else stem.when(k == i, F.lit(s))
    name = F.concat(F.upper(F.substring(stem, 1, 1)), F.substring(stem, 2, 1000), F.lit("_"),
                    F.substring("school_year", 5, 4), F.lit(".csv"))
    files = w.select(name.alias("file_name")).distinct()
    return files.select("file_name", IO.classify_file("file_name").alias("file_type"))


def write_survey_csv(spark, sf) -> str:
    root = scratch_path(spark, "survey-csv")
    fixtures.survey(Tables(spark, sf)).write.mode("overwrite").options(**CSV_OPTS).csv(root)
    return root


# A CSV round trip reads an empty cell as missing (as the exports' reader does),
# so the oracle applies the same: '' is null.
@register("scan_prefilter", ctes("fx_s") + "SELECT * FROM fx_s WHERE question_type IS NOT NULL AND NULLIF(question_index, '') IS NOT NULL")
def scan_prefilter_q(spark, sf):
    root = write_survey_csv(spark, sf)
    raw = IO.scan_raw_csv(spark, f"{root}/*.csv")
    # the predicate reaches the CSV scan (PushedFilters), so dropped rows are never materialised
    return raw.filter(F.col("question_type").isNotNull() & F.col("question_index").isNotNull()).drop("_source_path", "_source_header", "_corrupt")


W_FORMAT_RULES = [("historical", [W_HEADERS_OLD["r_rate"]]), ("newest", [W_HEADERS_NEW["r_rate"]])]


@register("detect_format", ctes("fx_w") + "SELECT CASE WHEN substr(school_year, 5, 4) < '1998' THEN 'historical' ELSE 'newest' END "
          "AS data_format, count(*) AS n_rows FROM fx_w GROUP BY 1")
def detect_format_q(spark, sf):
    raw = scanned_wide(spark, sf)
    return IO.detect_format(raw, W_FORMAT_RULES).groupBy("data_format").agg(F.count(F.lit(1)).alias("n_rows"))


@register("sink_kpi", ctes("fx_k") + f"SELECT {', '.join(S.KPI_LIST)}, 'wide' AS source FROM fx_k")
def sink_kpi_q(spark, sf):
    path = scratch_path(spark, "kpi-table")
    IO.sink_kpi(kpi_long(Tables(spark, sf)), path, "wide")
    return IO.read_kpi(spark, path)


@register("sink_heatmap_json", ctes("hm") + """SELECT 'wide' AS source, metric, 'school' AS kind, year, school_name, school_rank, student_group, value,
 CAST(NULL AS BIGINT) AS total_schools, CAST(NULL AS BIGINT) AS total_demographics, CAST(NULL AS BIGINT) AS data_points,
 CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS avg_value, CAST(NULL AS VARCHAR) AS error FROM hm
UNION ALL SELECT 'wide', c.metric, 'stats', c.year, NULL, NULL, NULL, NULL, c.total_schools, g.total_demographics, c.data_points,
 c.min_value, c.max_value, round(g.avg_value, 6), NULL FROM
 (SELECT metric, year, count(DISTINCT school_name) AS total_schools, count(cell) AS data_points,
         round(min(cell), 6) AS min_value, round(max(cell), 6) AS max_value FROM hm GROUP BY metric, year) c
 JOIN (SELECT metric, year, count(*) AS total_demographics, avg(gm) AS avg_value FROM
       (SELECT metric, year, student_group, avg(cell) AS gm FROM hm GROUP BY metric, year, student_group) x GROUP BY metric, year) g
 ON c.metric = g.metric AND c.year = g.year
UNION ALL SELECT 'wide', 'never_delivered', 'empty', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'No data available for this metric'""")
def sink_heatmap_json_q(spark, sf):
    path = scratch_path(spark, "heatmap-json")
    kpi = kpi_long(Tables(spark, sf))
    cells = materialized(DB.heatmap_cells(kpi), "heatmap-ranked")
    stats = DB.heatmap_stats(cells)
    stats = stats.withColumns({c: F.round(c, 6) for c in ("min_value", "max_value", "avg_value")})
    wanted = stats.select("metric").unionByName(local_table(spark, [("never_delivered",)], "metric string"))
    IO.sink_heatmap_json(cells, stats, path, "wide", wanted)
    return IO.read_heatmap_json(spark, path)
