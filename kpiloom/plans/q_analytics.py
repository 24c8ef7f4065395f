"""Events and climate jobs, joins, grouped analytics and the master table
(SURVEY 2.6 events / climate, 2.8, 2.9, union)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.operators import dashboard as DB
from kpiloom.operators.climate import dedupe_latest, survey_index_mean
from kpiloom.operators.events import incident_rate, tier_split
from kpiloom.operators.longform import Entry, null_marker_strings, wide_to_long, with_kpi_ids
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes, define, kpi_cols, pipeline
from kpiloom.plans.q_jobs import FLAG_SQL, IDS_SQL, JOB_SPECS, JOB_SQL
from kpiloom.plans.q_long import T_IDS, T_RENAME, T_VALUES, _ae, always_spec
from kpiloom.plans.registry import register
from kpiloom.plans.specs import run_spec
from kpiloom.plans.wide_kpi import W_IDS, kpi_long, with_second_delivery
from kpiloom.schema import LOGICAL_KEY, select_kpi_columns
from kpiloom.session import materialized, scratch_path, writer_settings
from kpiloom.sources import fixtures
from kpiloom.sources.csv_io import read_kpi, sink_kpi
from kpiloom.sources.master import union_master
from kpiloom.sources.store import stored_schema_check, update_master
from kpiloom.sources.tables import Tables

KPI = ", ".join(S.KPI_LIST)


# --- events: tiers, melt, mapping, incident rate ---------------------------------
def events_long(t: Tables, rows: DataFrame | None = None):
    tt = null_marker_strings(fixtures.tiers(t, rows))
    tt = tier_split(tt.select(*T_IDS, *[C.parse_number(v).alias(v) for v in T_VALUES]))
    ids = with_kpi_ids(tt, W_DIMS, flag=F.lit("N"),
                       source_file=F.concat(F.lit("events_"), C.year_from_school_year("school_year"), F.lit(".csv")))
    ids = ids.withColumns({"student_group": F.coalesce("tier_group", "student_group"),
                           "school_id": F.coalesce("school_id", C.clean_school_id("state_school_id"))})
    entries = [Entry(F.concat("metric_prefix", F.lit(T_RENAME[v]), "metric_suffix"), F.col(v), F.lit(True))
               for v in T_VALUES]
    return wide_to_long(ids, entries, "metric")


def events_job(t: Tables, rows: DataFrame | None = None):
    """``rows``: line items, where the caller has stored them."""
    long = events_long(t, rows)
    return long.unionByName(incident_rate(long))


_T_IDS_SQL = ", ".join(f"{S.nm(c)} AS {c}" for c in T_IDS)
_TIER = ("CASE WHEN demographic IN ('All Students', 'all students', 'ALL STUDENTS') THEN 1 "
         "WHEN demographic IN ('Total Events', 'total events', 'TOTAL EVENTS') THEN 3 ELSE 2 END")
define("ev_prep", f"SELECT *, CASE WHEN tier = 1 THEN 'safe_students_affected_' ELSE 'safe_event_count_' END AS metric_prefix, "
       "CASE WHEN tier = 2 THEN '_by_demo' ELSE '' END AS metric_suffix, CASE WHEN tier = 1 THEN 'All Students' "
       "WHEN tier = 3 THEN 'All Students - Total Events' END AS tier_group FROM (SELECT "
       f"{', '.join(T_IDS)}, " + ", ".join(f"{S.num(v)} AS {v}" for v in T_VALUES) + f", {_TIER} AS tier FROM "
       f"(SELECT {_T_IDS_SQL}, " + ", ".join(f"{S.nm(v)} AS {v}" for v in T_VALUES) + " FROM fx_t) a) b", ["fx_t"])
_EV_FILE = "'events_' || " + S.yearx("school_year") + " || '.csv'"
_EV_IDS = S.ids_select(T_IDS, S.yearx("school_year"), _EV_FILE, [*T_VALUES, "metric_prefix", "metric_suffix", "tier_group"],
                       flag_sql="'N'")
define("ev_ids", f"SELECT {_EV_IDS} FROM ev_prep", ["ev_prep"])
define("ev_map", S.mapping_select("ev_ids"), ["ev_ids", "dm"])
define("ev_fix", f"SELECT * REPLACE (COALESCE(tier_group, student_group) AS student_group, "
       f"COALESCE(school_id, {S.sid('state_school_id')}) AS school_id) FROM ev_map", ["ev_map"])
define("ev_long", S.emit("ev_fix", [(f"metric_prefix || '{T_RENAME[v]}' || metric_suffix", v, "TRUE") for v in T_VALUES],
                         "metric"), ["ev_fix"])
_LOC = S.PASSTHROUGH
_EV_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ["source_file", "value", *_LOC])
_EV_KEY = "district, school_id, school_name, year, base_metric"


def _tier_sql(long: str, prefix: str, group: str, valid: str) -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_EV_KEY} ORDER BY {_EV_ORDER}) AS rn FROM "
            f"(SELECT *, replace(metric, '{prefix}', '') AS base_metric FROM {long} WHERE starts_with(metric, '{prefix}') "
            f"AND student_group = '{group}' AND {valid}) x) y WHERE rn = 1")


def rate_sql(long: str) -> str:
    """Incident rates over a CTE of long event rows."""
    return f"""SELECT 'safe_incident_rate_' || a.base_metric AS metric, a.district, a.school_name, 'All Students' AS student_group,
 round_even(b.value / a.value, 3) AS value, 'N' AS suppressed, a.school_id, a.year,
 {', '.join(f'COALESCE(a.{c}, b.{c}) AS {c}' for c in _LOC)}, 'derived_rates_' || a.base_metric AS source_file
FROM ({_tier_sql(long, 'safe_students_affected_', 'All Students', 'value > 0')}) a
JOIN ({_tier_sql(long, 'safe_event_count_', 'All Students - Total Events', "value >= 0 AND NOT contains(metric, '_by_demo') AND NOT contains(metric, 'students_affected')")}) b
 ON a.district IS NOT DISTINCT FROM b.district AND a.school_id IS NOT DISTINCT FROM b.school_id
 AND a.school_name IS NOT DISTINCT FROM b.school_name AND a.year IS NOT DISTINCT FROM b.year AND a.base_metric = b.base_metric"""


define("ev_rate", rate_sql("ev_long"), ["ev_long"])
define("ev_job", f"SELECT {KPI} FROM ev_long UNION ALL SELECT {KPI} FROM ev_rate", ["ev_long", "ev_rate"])


@register("job_events", ctes("ev_job") + "SELECT * FROM ev_job")
def job_events_q(spark, sf):
    return events_job(Tables(spark, sf))


@register("tier_split", ctes("ev_prep") + "SELECT school_year, school_code, demographic, tier, metric_prefix, metric_suffix, "
          "tier_group FROM ev_prep")
def tier_split_q(spark, sf):
    t = fixtures.tiers(Tables(spark, sf))
    return tier_split(t).select("school_year", "school_code", "demographic", "tier", "metric_prefix", "metric_suffix",
                                "tier_group")


@register("incident_rate", ctes("ev_rate") + f"SELECT {KPI} FROM ev_rate")
def incident_rate_q(spark, sf):
    return incident_rate(events_long(Tables(spark, sf)))


# --- climate: survey means, policy compliance, combined rate, dedupe --------------
SURVEY_GROUPS = ["district", "year", "student_group", "school_code", "co_op", "source_file"]


def survey_frame(t: Tables):
    s = fixtures.survey(t)
    return s.select(F.col("district_name").alias("district"), C.year_from_school_year("school_year").alias("year"),
                    F.lit("All Students").alias("student_group"), "school_code", "co_op",
                    F.concat(F.lit("survey_"), C.year_from_school_year("school_year"), F.lit(".csv")).alias("source_file"),
                    "question_type", "question_index")


define("sv_rows", f"""SELECT district_name AS district, {S.yearx('school_year')} AS year, 'All Students' AS student_group, school_code,
 COALESCE(co_op, '999') AS co_op, 'survey_' || {S.yearx('school_year')} || '.csv' AS source_file,
 CASE WHEN upper(trim(question_type)) IN ('C', 'CLIMATE') THEN 'climate_index_score_calculated'
      WHEN upper(trim(question_type)) IN ('S', 'SAFETY') THEN 'safety_index_score_calculated' END AS metric,
 {S.num('question_index')} AS score
FROM fx_s WHERE question_type IS NOT NULL AND question_index IS NOT NULL AND question_index <> '' AND question_index <> '*'""", ["fx_s"])
define("sv_sum", "SELECT district, year, student_group, school_code, co_op, source_file, metric, "
       "avg(score) AS s, count(score) AS n FROM sv_rows WHERE metric IS NOT NULL AND score IS NOT NULL "
       "GROUP BY district, year, student_group, school_code, co_op, source_file, metric", ["sv_rows"])
define("sv_mean", "SELECT district, year, student_group, school_code, co_op, source_file, metric, "
       "round_even(round(s, 9), 1) AS value, "
       "n AS question_count, 'N' AS suppressed FROM sv_sum", ["sv_sum"])


@register("survey_index_mean", ctes("sv_mean") + "SELECT * FROM sv_mean")
def survey_index_mean_q(spark, sf):
    return survey_index_mean(survey_frame(Tables(spark, sf)), SURVEY_GROUPS)


POLICY_COLS = [f"policy_{i}" for i in range(1, 9)]


def climate_parts(t: Tables, wide: DataFrame | None = None):
    """``wide``: W, where the caller has stored it."""
    means = survey_index_mean(survey_frame(t), SURVEY_GROUPS)
    means = select_kpi_columns(means.withColumns({
        "school_id": C.clean_school_id("school_code"), "school_name": C.standardize_school_name(F.lit(None).cast("string"))}))
    p = fixtures.policies(t)
    p = p.select("school_code", "district_name", D.policy_compliance(POLICY_COLS).alias("rate"))
    p = with_kpi_ids(p, W_DIMS, flag=F.lit("N"), source_file=F.lit("precautionary_measures_2024.csv"))
    policy = wide_to_long(p, [Entry("safety_policy_compliance_rate", F.col("rate"))], "row")
    own = [*W_IDS, "suppressed", "a_rate", "r_rate"]
    w = null_marker_strings(fixtures.wide_parts(t, own) if wide is None else wide.select(*own))
    direct = F.substring("school_year", 5, 4) >= "1998"
    rate = lambda c: C.range_guard(C.parse_number(c), 0, 100)
    w = w.select(*W_IDS, C.suppression_flag("suppressed").alias("suppressed"), direct.alias("direct"),
                 F.when(direct, rate("a_rate")).otherwise(rate("r_rate")).alias("climate"), rate("r_rate").alias("safety"))
    from kpiloom.operators.longform import skip_aggregate_rows
    w = with_kpi_ids(skip_aggregate_rows(w), W_DIMS,
                     source_file=F.concat(F.when(F.col("direct"), "index_scores_").otherwise("accountability_"), F.substring("school_year", 5, 4), F.lit(".csv")))
    combined = wide_to_long(w, [Entry("climate_index_score", F.col("climate")), Entry("safety_index_score", F.col("safety"))],
                            "row", ["climate_index_score", "safety_index_score"])
    return means.unionByName(policy).unionByName(combined)


_POL_ANS = "(" + " + ".join(f"CASE WHEN {p} IS NOT NULL THEN 1 ELSE 0 END" for p in POLICY_COLS) + ")"
_POL_YES = "(" + " + ".join(f"CASE WHEN upper(trim({p})) = 'YES' THEN 1 ELSE 0 END" for p in POLICY_COLS) + ")"
_NULLS = "CAST(NULL AS VARCHAR)"
define("cl_parts", f"""
SELECT {kpi_cols(school_name="'Unknown School'", school_id=S.sid('school_code'), county_number=_NULLS, county_name=_NULLS,
                 district_number=_NULLS, state_school_id=_NULLS, nces_id=_NULLS, co_op_code=_NULLS, school_type=_NULLS)} FROM sv_mean
UNION ALL
SELECT '2024', 'safety_policy_compliance_rate', district_name, 'Unknown School', 'All Students',
 CASE WHEN {_POL_ANS} > 0 THEN round_even({_POL_YES} / {_POL_ANS} * 100, 1) END, 'N', NULL, NULL, NULL, {S.sid('school_code')},
 school_code, NULL, NULL, NULL, NULL, NULL, 'precautionary_measures_2024.csv'
FROM fx_p WHERE {_POL_ANS} > 0 AND {S.sid('school_code')} IS NOT NULL""", ["sv_mean", "fx_p"])
_cl_w = pipeline(
    "clw", f"{IDS_SQL}, {FLAG_SQL} AS suppressed, CASE WHEN substr(school_year, 5, 4) >= '1998' THEN {S.guard(S.num('a_rate'), 0, 100)} "
    f"ELSE {S.guard(S.num('r_rate'), 0, 100)} END AS climate, {S.guard(S.num('r_rate'), 0, 100)} AS safety", "fx_wn", ["fx_wn"],
    W_IDS + ["suppressed"], ["climate", "safety"], [("'climate_index_score'", "climate"), ("'safety_index_score'", "safety")], "row",
    [("'climate_index_score'",), ("'safety_index_score'",)],
    source_file_sql="CASE WHEN substr(school_year, 5, 4) >= '1998' THEN 'index_scores_' ELSE 'accountability_' END || substr(school_year, 5, 4) || '.csv'")
define("cl_all", f"SELECT {KPI} FROM cl_parts UNION ALL SELECT * FROM ({_cl_w[1]}) z", ["cl_parts", "clw_map"])
_DEDUP_ORDER = ["source_file", "value", "suppressed"] + sorted(
    c for c in S.KPI_LIST if c not in LOGICAL_KEY and c not in ("source_file", "value", "suppressed"))


def dedupe_sql(src: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in _DEDUP_ORDER)
    return (f"SELECT {KPI} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(LOGICAL_KEY)} ORDER BY {order}) AS rn "
            f"FROM {src}) d WHERE rn = 1")


@register("job_climate", ctes("cl_all") + dedupe_sql("cl_all"))
def job_climate_q(spark, sf):
    return dedupe_latest(climate_parts(Tables(spark, sf)))


define("kk2", f"SELECT {KPI} FROM fx_k UNION ALL SELECT {KPI} FROM fx_k2", ["fx_k", "fx_k2"])


@register("dedupe_latest", ctes("kk2") + dedupe_sql("kk2"))
def dedupe_latest_q(spark, sf):
    return dedupe_latest(with_second_delivery(kpi_long(Tables(spark, sf))))


# --- rate pair compare over the readiness job --------------------------------------
define("rp_rows", _ae[1], ["ae_map"])
define("rp", """SELECT count(*) AS n_pairs,
 round(CAST(count(*) FILTER (WHERE b.value >= a.value) AS DOUBLE) / NULLIF(count(*), 0), 6) AS share_bonus_ge_base,
 min(a.value) FILTER (WHERE b.value > 100) AS min_base_when_bonus_over_100,
 max(a.value) FILTER (WHERE b.value > 100) AS max_base_when_bonus_over_100
FROM (SELECT * FROM rp_rows WHERE metric = 'postsecondary_readiness_rate' AND value IS NOT NULL) a
JOIN (SELECT * FROM rp_rows WHERE metric = 'postsecondary_readiness_rate_with_bonus' AND value IS NOT NULL) b
 ON a.school_id = b.school_id AND a.student_group = b.student_group AND a.year = b.year AND a.district = b.district""", ["rp_rows"])


@register("rate_pair_compare", ctes("rp") + "SELECT * FROM rp")
def rate_pair_compare_q(spark, sf):
    kpi = run_spec(always_spec(), fixtures.wide(Tables(spark, sf)), W_DIMS)
    key = ["district", "school_id", "student_group", "year"]
    m = F.col("metric")
    pairs = (kpi.filter(F.col("value").isNotNull())
                .groupBy(*key).agg(F.max(F.when(m == "postsecondary_readiness_rate", F.col("value"))).alias("base"),
                                   F.max(F.when(m == "postsecondary_readiness_rate_with_bonus", F.col("value"))).alias("bonus"))
                .filter(F.col("base").isNotNull() & F.col("bonus").isNotNull()))
    b, x = F.col("base"), F.col("bonus")
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.round(F.count_if(x >= b) / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("share_bonus_ge_base"),
                     F.min(F.when(x > 100, b)).alias("min_base_when_bonus_over_100"),
                     F.max(F.when(x > 100, b)).alias("max_base_when_bonus_over_100"))


# --- dashboard queries over K -------------------------------------------------------
define("lat", "SELECT k.* FROM fx_k k JOIN (SELECT metric, max(year) AS y FROM fx_k WHERE suppressed = 'N' AND value IS NOT NULL "
       "GROUP BY metric) m ON k.metric = m.metric AND k.year = m.y WHERE k.suppressed = 'N' AND k.value IS NOT NULL", ["fx_k"])


@register("latest_year", ctes("lat") + "SELECT * FROM lat")
def latest_year_q(spark, sf):
    return DB.latest_year(kpi_long(Tables(spark, sf)))


define("hm_cells", "SELECT metric, year, school_name, student_group, avg(value) AS cell FROM lat GROUP BY metric, year, school_name, student_group", ["lat"])
define("hm_rank", "SELECT metric, school_name, row_number() OVER (PARTITION BY metric ORDER BY round(avg(cell), 9) DESC, school_name ASC) AS school_rank "
       "FROM hm_cells GROUP BY metric, school_name", ["hm_cells"])
define("hm", "SELECT c.metric, c.year, c.school_name, r.school_rank, c.student_group, round_even(c.cell, 1) AS value, c.cell "
       "FROM hm_cells c JOIN hm_rank r ON c.metric = r.metric AND c.school_name = r.school_name", ["hm_cells", "hm_rank"])


@register("heatmap_cells", ctes("hm") + "SELECT metric, year, school_name, school_rank, student_group, value FROM hm")
def heatmap_cells_q(spark, sf):
    return DB.heatmap_cells(kpi_long(Tables(spark, sf))).select(
        "metric", "year", "school_name", "school_rank", "student_group", "value")


# Fixed values (fixture): the groups that have a column of their own.
PIVOT_GROUPS = ["All Students", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@register("heatmap_pivot", ctes("hm") + """SELECT metric, year, school_name, school_rank,
 max(value) FILTER (WHERE student_group = 'All Students') AS "All Students", max(value) FILTER (WHERE student_group = 'AUTOMOBILE') AS "AUTOMOBILE",
 max(value) FILTER (WHERE student_group = 'BUILDING') AS "BUILDING", max(value) FILTER (WHERE student_group = 'FURNITURE') AS "FURNITURE",
 max(value) FILTER (WHERE student_group = 'HOUSEHOLD') AS "HOUSEHOLD",
 count(*) FILTER (WHERE student_group NOT IN ('All Students', 'AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')) AS n_other_groups,
 max(value) FILTER (WHERE student_group = 'MACHINERY') AS other_machinery
FROM hm WHERE metric = 'r_rate' GROUP BY metric, year, school_name, school_rank""")
def heatmap_pivot_q(spark, sf):
    wide = DB.heatmap_pivot(kpi_long(Tables(spark, sf)), "r_rate", PIVOT_GROUPS)
    return wide.select("metric", "year", "school_name", "school_rank", *PIVOT_GROUPS, F.size("other_groups").cast("bigint").alias("n_other_groups"),
                       F.col("other_groups")["MACHINERY"].alias("other_machinery"))


@register("heatmap_stats", ctes("hm") + """SELECT c.metric, c.year, c.total_schools, c.data_points, c.min_value, c.max_value,
 g.total_demographics, round(g.avg_value, 6) AS avg_value FROM
 (SELECT metric, year, count(DISTINCT school_name) AS total_schools, count(cell) AS data_points,
         round(min(cell), 6) AS min_value, round(max(cell), 6) AS max_value FROM hm GROUP BY metric, year) c
 JOIN (SELECT metric, year, count(*) AS total_demographics, avg(gm) AS avg_value FROM
       (SELECT metric, year, student_group, avg(cell) AS gm FROM hm GROUP BY metric, year, student_group) x GROUP BY metric, year) g
 ON c.metric = g.metric AND c.year = g.year""")
def heatmap_stats_q(spark, sf):
    st = DB.heatmap_stats(DB.latest_cells(kpi_long(Tables(spark, sf))))
    return st.select("metric", "year", "total_schools", "data_points", F.round("min_value", 6).alias("min_value"),
                     F.round("max_value", 6).alias("max_value"), "total_demographics",
                     F.round("avg_value", 6).alias("avg_value"))


@register("suppression_profile", ctes("fx_k") + "SELECT metric, count(*) FILTER (WHERE suppressed = 'Y') AS suppressed_rows, "
          "count(*) FILTER (WHERE suppressed = 'N') AS reported_rows FROM fx_k GROUP BY metric")
def suppression_profile_q(spark, sf):
    return DB.suppression_profile(kpi_long(Tables(spark, sf)))


@register("value_profile", ctes("fx_k") + "SELECT metric, min(value) AS min_value, max(value) AS max_value, count(*) AS n_rows "
          "FROM fx_k GROUP BY metric")
def value_profile_q(spark, sf):
    k = kpi_long(Tables(spark, sf))
    return k.groupBy("metric").agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                                   F.count(F.lit(1)).alias("n_rows"))


@register("value_profile_top_groups", ctes("fx_k") + "SELECT student_group, count(*) AS n_rows FROM fx_k GROUP BY student_group "
          "ORDER BY n_rows DESC, student_group ASC LIMIT 10")
def value_profile_top_q(spark, sf):
    return DB.value_profile(kpi_long(Tables(spark, sf)))[2]


# --- master table and its profiles ---------------------------------------------------
# The thirteen sources of the master table, and their jobs.
MASTER_SOURCES = {"graduation_rates": "job_graduation", "chronic_absenteeism": "job_absenteeism", "english_learner_progress": "job_english_learner",
                  "kindergarten_readiness": "job_kindergarten", "out_of_school_suspension": "job_suspension",
                  "postsecondary_enrollment": "job_postsec_enrollment", "postsecondary_readiness": "job_postsec_readiness",
                  "kentucky_summative_assessment": "job_assessment", "cte_participation": "job_cte", "student_enrollment": "job_enrollment",
                  "safe_schools_discipline": "job_discipline", "safe_schools_climate": "job_climate", "safe_schools_events": "job_events"}


# Sources whose rows are grouped once more after the exports are read; the others lie by year as these do.
REGROUPED = ["safe_schools_climate", "safe_schools_events"]


def master_jobs(spark, sf):
    """source -> KPI rows of its job, for all thirteen.  The line items and the
    exports that several jobs read are written once."""
    t = Tables(spark, sf)
    rows = materialized(fixtures.line_items(t), "line-items")
    exports = {"W": fixtures.wide_parts(t, rows=rows, by_year=True), "B": fixtures.bands(t, rows, by_year=True)}
    jobs = {job: run_spec(spec(), exports[fixture], W_DIMS) for job, (spec, fixture) in JOB_SPECS.items()}
    jobs |= {"job_climate": dedupe_latest(climate_parts(t, exports["W"])), "job_events": events_job(t, rows)}
    return {name: jobs[job] for name, job in MASTER_SOURCES.items()}


def master(spark, sf):
    """All thirteen jobs stacked, with an audit table and one of too few columns
    that are left out."""
    sources = list(master_jobs(spark, sf).items())
    sample = Tables(spark, sf).region
    sources += [("graduation_rates_demographic_audit", sample.select(F.col("r_name").alias("original"))),
                ("short_header", sample.select(F.col("r_name").alias("district"), F.lit("m").alias("metric")))]
    return union_master(spark, sources)


_MASTER_ORACLE = {**{name: f"({JOB_SQL[job]})" for name, job in MASTER_SOURCES.items() if job in JOB_SQL},
                  "safe_schools_climate": f"({dedupe_sql('cl_all')})", "safe_schools_events": "ev_job"}
define("master", "\nUNION ALL ".join(f"SELECT {KPI}, '{name}' AS source FROM {sql} s{i}" for i, (name, sql) in enumerate(_MASTER_ORACLE.items())),
       [*(f"{job}_map" for job in JOB_SQL if job != "job_postsec_readiness"), "ae_map", "cl_all", "ev_job"])


@register("union_master", ctes("master") + "SELECT * FROM master")
def union_master_q(spark, sf):
    return master(spark, sf)


@register("select_metrics_regex", ctes("master") + "SELECT DISTINCT metric FROM master WHERE contains(metric, '_rate') OR "
          "(regexp_matches(metric, 'out_of_school_suspension.*_count') AND contains(metric, 'total_count'))")
def select_metrics_regex_q(spark, sf):
    return DB.select_metrics_regex(master(spark, sf))


@register("source_profile", ctes("master") + """SELECT source,
 array_to_string(list_sort(list_distinct(list(CASE WHEN contains(metric, '_rate') OR (regexp_matches(metric, 'out_of_school_suspension.*_count')
   AND contains(metric, 'total_count')) THEN metric END))), ',') AS rate_metrics,
 array_to_string(list_sort(list_distinct(list(year))), ',') AS years, count(*) AS total_rows, count(*) > 0 AS data_available
FROM master GROUP BY source""")
def source_profile_q(spark, sf):
    return DB.source_profile(master(spark, sf))


# --- stored KPI tables, and the master that follows them ------------------------------
# The sources of the incremental master; the second delivery of one of them starts here.
STORED = {"graduation_rates": "job_graduation", "cte_participation": "job_cte", "safe_schools_discipline": "job_discipline"}
NEW_YEAR = "1998"


def stored_jobs(spark, sf):
    """source -> KPI rows of its job over the exports, written once."""
    exports = fixtures.wide_parts(Tables(spark, sf))
    return {name: run_spec(JOB_SPECS[job][0](), exports, W_DIMS) for name, job in STORED.items()}


_STORED_SQL = "\nUNION ALL ".join(f"SELECT {KPI}, '{name}' AS source FROM ({JOB_SQL[job]}) s{i}" for i, (name, job) in enumerate(STORED.items()))
define("stored", _STORED_SQL, [f"{job}_map" for job in STORED.values()])


@register("kpi_schema_check", ctes("master") + """SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE value IS NOT NULL AND
 TRY_CAST(value AS DOUBLE) IS NULL) AS n_bad_value, '' AS missing_columns FROM master GROUP BY source
UNION ALL SELECT 'planted_short', count(*), 0, 'district,value' FROM master WHERE source = 'cte_participation'
UNION ALL SELECT 'planted_text', count(*), count(*) FILTER (WHERE value IS NULL), '' FROM master WHERE source = 'cte_participation'""")
def kpi_schema_check_q(spark, sf):
    """All thirteen sources as stored, a planted table without two columns and one with text among its values."""
    path = scratch_path(spark, "schema-check")
    for name, kpi in master_jobs(spark, sf).items():
        sink_kpi(kpi, path, name, by_year=name not in REGROUPED)
    cte = read_kpi(spark, path).filter(F.col("source") == "cte_participation").drop("source")
    planted = {"short": cte.drop("district", "value"), "text": cte.withColumn("value", F.coalesce(F.col("value").cast("string"), F.lit("n/a")))}
    with writer_settings(spark):
        for kind, table in planted.items():
            table.write.partitionBy("year").parquet(f"{path}/source=planted_{kind}")
    return stored_schema_check(spark, path)


@register("master_incremental", ctes("stored") + "SELECT * FROM stored")
def master_incremental_q(spark, sf):
    """Built from a first delivery that ends before NEW_YEAR for two sources, and
    brought up to date once their other years are stored."""
    kpi, master_table, manifest = (scratch_path(spark, f"store-{x}") for x in ("kpi", "master", "manifest"))
    late = f"year >= '{NEW_YEAR}'"
    jobs, both = stored_jobs(spark, sf), [n for n in STORED if n != "safe_schools_discipline"]
    for name, rows in jobs.items():
        sink_kpi(rows.filter(f"NOT ({late})") if name in both else rows, kpi, name)
    update_master(spark, kpi, master_table, manifest)
    for name in both:
        sink_kpi(jobs[name].filter(late), kpi, name)
    update_master(spark, kpi, master_table, manifest)
    return read_kpi(spark, master_table)
