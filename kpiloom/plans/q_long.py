"""Emission policies, melt, dynamic names and KPI column order."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import labels as L
from kpiloom.operators.events import melt_renamed
from kpiloom.operators.longform import Entry, with_kpi_ids
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import W_FLAG_SQL, W_IDS_SQL, ctes, define, pipeline
from kpiloom.plans.q_normalize import (supp, SUPP_SQL, level_text, sql_grade, sql_grade_to_level, sql_level,
                                       sql_subject, LEVEL_TEXT_SQL)
from kpiloom.plans.registry import register
from kpiloom.plans.specs import SourceSpec, run_spec
from kpiloom.plans.wide_kpi import W_IDS, W_MEASURES
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

W_IDS_COLS = list(W_IDS)


def _w(spark, sf):
    return fixtures.wide(Tables(spark, sf))


def _measure_cols(flag_col):
    return [*W_IDS_COLS, flag_col.alias("suppressed"),
            *[C.range_guard(C.parse_number(src), lo, hi).alias(m) for m, (src, lo, hi) in W_MEASURES.items()]]


_MEAS_SQL = [f"{S.guard(S.num(S.nm(src)), lo, hi)} AS {m}" for m, (src, lo, hi) in W_MEASURES.items()]
_PLANTED_SQL = f"CASE WHEN {SUPP_SQL} % 4 = 0 THEN 'Y' ELSE {W_FLAG_SQL} END"

# --- suppressed_defaults: planted flags on rows that carry data ---------------
_sd = pipeline("sd", f"{W_IDS_SQL}, {_PLANTED_SQL} AS suppressed, {', '.join(_MEAS_SQL)}", "fx_w", ["fx_w"],
               W_IDS_COLS + ["suppressed"], list(W_MEASURES), [(f"'{m}'", m) for m in W_MEASURES], "row",
               [(f"'{m}'",) for m in W_MEASURES])


@register("suppressed_defaults", _sd[0] + f"SELECT * FROM ({_sd[1]}) z WHERE suppressed = 'Y'")
def suppressed_defaults_q(spark, sf):
    spec = SourceSpec(
        "suppressed_defaults",
        prepare=lambda w: w.select(*_measure_cols(F.when(supp() % 4 == 0, F.lit("Y")).otherwise(C.suppression_flag("suppressed")))),
        entries=lambda: [Entry(m, F.col(m)) for m in W_MEASURES],
        defaults=lambda: list(W_MEASURES))
    return run_spec(spec, _w(spark, sf), W_DIMS).filter(F.col("suppressed") == "Y")


# --- metric_level_suppression: four parts, one may be negative ---------------
_PARTS = {"oss_a_count": "a_count", "oss_n_count": "n_count", "oss_r_count": "r_count"}
_mls_prep = (f"{W_IDS_SQL}, {W_FLAG_SQL} AS suppressed, "
             + ", ".join(f"{S.num(S.nm(src))} AS {m}, {S.nm(src)} AS {m}_text" for m, src in _PARTS.items()))
_mls_entries = [(f"'{m}'", m, f"{m}_text IS NOT NULL") for m in _PARTS]
_mls_entries.append(("'oss_r_minus_a_count'", "oss_r_count - oss_a_count",
                     "oss_r_count_text IS NOT NULL AND oss_a_count_text IS NOT NULL"))
_mls_measures = [c for m in _PARTS for c in (m, f"{m}_text")]
_mls = pipeline("mls", _mls_prep, "fx_w", ["fx_w"], W_IDS_COLS + ["suppressed"], _mls_measures, _mls_entries, "metric",
                [(f"'{m}'",) for m in [*_PARTS, "oss_r_minus_a_count"]])


def _mls_spec():
    def prep(w):
        return w.select(*W_IDS_COLS, C.suppression_flag("suppressed").alias("suppressed"),
                        *[x for m, src in _PARTS.items()
                          for x in (C.parse_number(src).alias(m), F.col(src).alias(f"{m}_text"))])

    def entries():
        es = [Entry(m, F.col(m), F.col(f"{m}_text").isNotNull()) for m in _PARTS]
        es.append(Entry("oss_r_minus_a_count", F.col("oss_r_count") - F.col("oss_a_count"),
                        F.col("oss_r_count_text").isNotNull() & F.col("oss_a_count_text").isNotNull()))
        return es

    return SourceSpec("metric_level_suppression", prep, entries,
                      defaults=lambda: [*_PARTS, "oss_r_minus_a_count"], policy="metric")


@register("metric_level_suppression", _mls[0] + _mls[1])
def metric_level_q(spark, sf):
    return run_spec(_mls_spec(), _w(spark, sf), W_DIMS)


# --- always_emit: base and bonus rate for every row ---------------------------
_RATE_SQL = S.num(S.nm("r_rate"))
_ae = pipeline("ae", f"{W_IDS_SQL}, {W_FLAG_SQL} AS suppressed, {S.guard(_RATE_SQL, 0, 100)} AS base_rate, "
               f"{S.guard(f'{_RATE_SQL} * 1.3', 0, 150)} AS bonus_rate", "fx_w", ["fx_w"], W_IDS_COLS + ["suppressed"],
               ["base_rate", "bonus_rate"],
               [("'postsecondary_readiness_rate'", "base_rate"), ("'postsecondary_readiness_rate_with_bonus'", "bonus_rate")],
               "always")


def always_spec():
    rate = C.parse_number("r_rate")
    return SourceSpec(
        "always_emit",
        prepare=lambda w: w.select(*W_IDS_COLS, C.suppression_flag("suppressed").alias("suppressed"),
                                   C.range_guard(rate, 0, 100).alias("base_rate"),
                                   C.range_guard(rate * 1.3, 0, 150).alias("bonus_rate")),
        entries=lambda: [Entry("postsecondary_readiness_rate", F.col("base_rate")),
                         Entry("postsecondary_readiness_rate_with_bonus", F.col("bonus_rate"))],
        policy="always")


@register("always_emit", _ae[0] + _ae[1])
def always_emit_q(spark, sf):
    return run_spec(always_spec(), _w(spark, sf), W_DIMS)


# --- positive_only: counts kept only when > 0, integer-truncated ---------------
_POS = {"restraint_count": ("a_count", 4), "seclusion_count": ("n_count", 3), "arrest_count": ("r_count", None)}


def _pos_sql(src, mod):
    v = S.num(S.nm(src))
    return f"trunc({v} % {mod})" if mod else f"trunc({v})"


_po = pipeline("po", f"{W_IDS_SQL}, {W_FLAG_SQL} AS suppressed, " + ", ".join(f"{_pos_sql(s, md)} AS {m}" for m, (s, md) in _POS.items()),
               "fx_w", ["fx_w"], W_IDS_COLS + ["suppressed"], list(_POS),
               [(f"'{m}'", m, f"{m} > 0") for m in _POS], "row", [(f"'{m}'",) for m in _POS])


def positive_spec():
    def prep(w):
        cols = []
        for m, (src, mod) in _POS.items():
            v = C.parse_number(src)
            cols.append(((v % mod) if mod else v).cast("bigint").cast("double").alias(m))
        return w.select(*W_IDS_COLS, C.suppression_flag("suppressed").alias("suppressed"), *cols)
    return SourceSpec("positive_only", prep, lambda: [Entry(m, F.col(m), F.col(m) > 0) for m in _POS],
                      defaults=lambda: list(_POS))


@register("positive_only", _po[0] + _po[1])
def positive_only_q(spark, sf):
    return run_spec(positive_spec(), _w(spark, sf), W_DIMS)


# --- melt_renamed over the event tiers ------------------------------------------
T_VALUES = ["total_events", "alpha_events", "return_events"]
T_RENAME = {"total_events": "total", "alpha_events": "alpha", "return_events": "returns"}
T_KEY = ["school_year", "school_code", "demographic", "state_school_id"]
T_IDS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic", "state_school_id"]


def _melt_sql(src: str, ids: list[str], prefix: str = "events_") -> str:
    parts = [f"SELECT {', '.join(ids)}, '{prefix}{T_RENAME[v]}' AS metric, {S.num(S.nm(v))} AS value, "
             f"CASE WHEN {S.num(S.nm(v))} IS NULL THEN 'Y' ELSE 'N' END AS suppressed FROM {src}" for v in T_VALUES]
    return "\nUNION ALL ".join(parts)


def melted_t(spark, sf, ids):
    from kpiloom.operators.longform import null_marker_strings
    t = null_marker_strings(fixtures.tiers(Tables(spark, sf)))
    t = t.select(*ids, *[C.parse_number(v).alias(v) for v in T_VALUES])
    return melt_renamed(t, ids, T_VALUES, T_RENAME, prefix="events_")


@register("melt_renamed", ctes("fx_t") + _melt_sql("fx_t", T_KEY))
def melt_renamed_q(spark, sf):
    return melted_t(spark, sf, T_KEY)


# --- select_kpi_columns: melted tiers with the id template in KPI order ---------
define("skc_melt", _melt_sql("fx_t", T_IDS), ["fx_t"])
define("skc_ids", f"SELECT {S.ids_select(T_IDS + ['metric', 'value', 'suppressed'], S.yearx('school_year'), 'metric', ['metric', 'value'])} "
       "FROM skc_melt", ["skc_melt"])
define("skc_map", S.mapping_select("skc_ids"), ["skc_ids", "dm"])


@register("select_kpi_columns", ctes("skc_map") + f"SELECT {', '.join(S.KPI_LIST)} FROM skc_map WHERE school_id IS NOT NULL")
def select_kpi_columns_q(spark, sf):
    from kpiloom.schema import select_kpi_columns
    long = melted_t(spark, sf, T_IDS)
    ids = with_kpi_ids(long, W_DIMS, source_file=F.col("metric"))
    return select_kpi_columns(ids.filter(F.col("school_id").isNotNull()))


# --- dynamic_metric_names over the assessment bands -------------------------------
BANDS = ["novice", "apprentice", "proficient", "distinguished"]
B_IDS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic"]


def _dyn_entries_spark():
    subj, grade = F.col("subject_n"), F.col("grade_n")
    level = F.col("level_n")
    out = []
    for b in BANDS:
        v = F.col(b)
        out.append(Entry(F.concat(F.lit("english_learner_"), F.lit(b), F.lit("_"), F.col("level_el")), v))
        out.append(Entry(F.concat_ws("_", F.lit("ksa"), subj, F.lit(f"{b}_rate"), grade), v,
                         v.isNotNull() & (grade != "all_grades")))
        out.append(Entry(F.concat_ws("_", F.lit("ksa"), subj, F.lit(f"{b}_rate"), level), v,
                         v.isNotNull() & (level != "all")))
    return out


def dyn_prepare(b):
    grade = L.normalize_grade("grade")
    return b.select(*B_IDS, C.suppression_flag("suppressed").alias("suppressed"),
                    L.normalize_subject("subject").alias("subject_n"), grade.alias("grade_n"),
                    F.when(grade != "all_grades", L.grade_to_level(grade)).otherwise(F.lit("all")).alias("level_n"),
                    L.normalize_level(level_text()).alias("level_el"),
                    *[C.range_guard(C.parse_number(x), 0, 100).alias(x) for x in BANDS])


_B_IDS_SQL = ", ".join(f"{S.nm(c)} AS {c}" for c in B_IDS)
_g = sql_grade(S.nm("grade"))
_dyn_prep = (f"{_B_IDS_SQL}, {S.flag(S.nm('suppressed'))} AS suppressed, {sql_subject(S.nm('subject'))} AS subject_n, "
             f"{_g} AS grade_n, CASE WHEN {_g} <> 'all_grades' THEN {sql_grade_to_level(_g)} ELSE 'all' END AS level_n, "
             f"{sql_level(LEVEL_TEXT_SQL.replace('subject', S.nm('subject')))} AS level_el, "
             + ", ".join(f"{S.guard(S.num(S.nm(x)), 0, 100)} AS {x}" for x in BANDS))
_dyn_entries = []
for _b in BANDS:
    _dyn_entries.append((f"'english_learner_{_b}_' || level_el", _b))
    _dyn_entries.append((f"concat_ws('_', 'ksa', subject_n, '{_b}_rate', grade_n)", _b, f"{_b} IS NOT NULL AND grade_n <> 'all_grades'"))
    _dyn_entries.append((f"concat_ws('_', 'ksa', subject_n, '{_b}_rate', level_n)", _b, f"{_b} IS NOT NULL AND level_n <> 'all'"))
_dyn = pipeline("dyn", _dyn_prep, "fx_b", ["fx_b"], B_IDS + ["suppressed"],
                ["subject_n", "grade_n", "level_n", "level_el", *BANDS], _dyn_entries, "row")


@register("dynamic_metric_names", _dyn[0] + f"SELECT year, school_id, metric, value, suppressed FROM ({_dyn[1]}) z")
def dynamic_metric_names_q(spark, sf):
    spec = SourceSpec("dynamic_metric_names", dyn_prepare, _dyn_entries_spark)
    return run_spec(spec, fixtures.bands(Tables(spark, sf)), W_DIMS).select("year", "school_id", "metric", "value", "suppressed")
