"""The thirteen source jobs as declarative specs.

Each job binds fixture columns to the source's measures (FIXTURES Part 3),
then runs the shared steps: markers -> typed wide -> skip aggregates -> id
template + broadcast demographic mapping -> emission policy -> KPI columns.
Climate and events add their grouped / joined parts in ``q_analytics``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.functions import labels as L
from kpiloom.operators.longform import Entry
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.entries import assessment_defaults, assessment_entries, kindergarten_defaults, kindergarten_entries
from kpiloom.plans.oracle_fixtures import define, pipeline
from kpiloom.plans.q_long import always_spec, _ae, BANDS, B_IDS
from kpiloom.plans.q_normalize import (LEVEL_TEXT_SQL, level_text, sql_grade, sql_grade_to_level, sql_level,
                                       sql_slug, sql_subject)
from kpiloom.plans.registry import register
from kpiloom.plans.specs import SourceSpec, run_spec
from kpiloom.plans.wide_kpi import W_IDS
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

_kg_entries = kindergarten_entries  # the name that readers of this module know
W_ALL = list(W_IDS) + ["suppressed", "total_count", "a_count", "n_count", "r_count", "qty_text", "r_rate", "a_rate",
                         *(f"part_{i}" for i in range(fixtures.N_PARTS))]
B_ALL = list(B_IDS) + ["subject", "grade", "suppressed", *BANDS]
define("fx_wn", "SELECT " + ", ".join(f"{S.nm(c)} AS {c}" for c in W_ALL) + " FROM fx_wp", ["fx_wp"])
define("fx_bn", "SELECT " + ", ".join(f"{S.nm(c)} AS {c}" for c in B_ALL) + " FROM fx_b", ["fx_b"])
IDS_SQL = ", ".join(W_IDS)
FLAG_SQL = S.flag("suppressed")
def suppk():
    return F.col("school_code").cast("bigint")
SUPPK_SQL = "CAST(school_code AS BIGINT)"


def n(c):
    return C.parse_number(c)


def ns(c):
    return S.num(c)


def _flag():
    return C.suppression_flag("suppressed")


def _w(spark, sf):
    return fixtures.wide(Tables(spark, sf))


JOB_SQL: dict[str, str] = {}
JOB_SPECS: dict[str, tuple[Callable[[], SourceSpec], str]] = {}


def _job(key, fixture, spark_prep, entries, defaults, policy, sql_prep, sql_cols, sql_measures, sql_entries,
         sql_defaults, source_file_sql=None, source_file=None):
    sf_sql = source_file_sql or f"'{key}_' || substr(school_year, 5, 4) || '.csv'"
    c, sel = pipeline(key, sql_prep, {"W": "fx_wn", "B": "fx_bn"}[fixture], [{"W": "fx_wn", "B": "fx_bn"}[fixture]],
                      sql_cols, sql_measures, sql_entries, policy, sql_defaults, source_file_sql=sf_sql)
    JOB_SQL[key] = sel
    sfc = source_file or (lambda: F.concat(F.lit(f"{key}_"), F.substring("school_year", 5, 4), F.lit(".csv")))
    spec = SourceSpec(key, spark_prep, entries, defaults, policy, sfc)
    JOB_SPECS[key] = (lambda: spec), fixture
    reader = {"W": fixtures.wide_parts, "B": fixtures.bands}[fixture]

    @register(key, c + sel)
    def _q(spark, sf):
        return run_spec(spec, reader(Tables(spark, sf)), W_DIMS)
    return spec


# 1. graduation ------------------------------------------------------------------
_GRAD = {"graduation_rate_4_year": ("r_rate", 0, 100), "graduation_count_4_year": ("r_count", 0, None),
         "graduation_total_4_year": ("total_count", 0, None), "graduation_rate_5_year": ("a_rate", 0, 100),
         "graduation_count_5_year": ("a_count", 0, None), "graduation_total_5_year": ("total_count", 0, None)}
# the oracle's own list of (metric, column, bounds)
_GRAD_ORACLE = [("graduation_rate_4_year", "r_rate", 100), ("graduation_rate_5_year", "a_rate", 100),
                ("graduation_count_4_year", "r_count", None), ("graduation_count_5_year", "a_count", None),
                ("graduation_total_4_year", "total_count", None), ("graduation_total_5_year", "total_count", None)]
_job("job_graduation", "W",
     lambda w: w.select(*W_IDS, _flag().alias("suppressed"),
                        *[C.range_guard(n(s), lo, hi).alias(m) for m, (s, lo, hi) in _GRAD.items()]),
     lambda: [Entry(m, F.col(m)) for m in _GRAD], lambda: list(_GRAD), "row",
     f"{IDS_SQL}, {FLAG_SQL} AS suppressed, " + ", ".join(f"{S.guard(ns(c), 0, hi)} AS {m}" for m, c, hi in _GRAD_ORACLE),
     W_IDS + ["suppressed"], [m for m, _, _ in _GRAD_ORACLE], [(f"'{m}'", m) for m, _, _ in _GRAD_ORACLE],
     [(f"'{m}'",) for m, _, _ in _GRAD_ORACLE])

# 2. chronic absenteeism: grade-suffixed names ------------------------------------
_ABS = {"rate": ("r_rate", 0, 100), "count": ("r_count", 0, None), "enrollment": ("qty_text", 0, None)}
_ABS_GRADE_SQL = sql_grade("'Grade ' || substr(school_year, 8, 1)")
_job("job_absenteeism", "W",
     lambda w: w.select(*W_IDS, _flag().alias("suppressed"),
                        L.normalize_grade(F.concat(F.lit("Grade "), F.substring("school_year", 8, 1))).alias("grade"),
                        *[C.range_guard(n(s), lo, hi).alias(k) for k, (s, lo, hi) in _ABS.items()]),
     lambda: [Entry(F.concat(F.lit(f"chronic_absenteeism_{k}_"), F.col("grade")), F.col(k)) for k in _ABS],
     lambda: [Entry(F.concat(F.lit(f"chronic_absenteeism_{k}_"), F.col("grade")), F.lit(None).cast("double"), F.lit(True))
              for k in _ABS], "row",
     f"{IDS_SQL}, {FLAG_SQL} AS suppressed, {_ABS_GRADE_SQL} AS grade, "
     + ", ".join(f"{S.guard(ns(s), lo, hi)} AS {k}" for k, (s, lo, hi) in _ABS.items()),
     W_IDS + ["suppressed"], ["grade", *_ABS], [(f"'chronic_absenteeism_{k}_' || grade", k) for k in _ABS],
     [(f"'chronic_absenteeism_{k}_' || grade",) for k in _ABS])

# 3. English learner progress over the bands -------------------------------------
_EL = {"score_0": "novice", "score_60_80": "apprentice", "score_100": "proficient", "score_140": "distinguished"}
_job("job_english_learner", "B",
     lambda b: b.select(*B_IDS, _flag().alias("suppressed"), L.normalize_level(level_text()).alias("level"),
                        *[C.range_guard(n(s), 0, 100).alias(k) for k, s in _EL.items()]),
     lambda: [Entry(F.concat(F.lit(f"english_learner_{k}_"), F.col("level")), F.col(k)) for k in _EL],
     lambda: [Entry(F.concat(F.lit(f"english_learner_{k}_"), F.col("level")), F.lit(None).cast("double"), F.lit(True))
              for k in _EL], "row",
     f"{', '.join(B_IDS)}, {FLAG_SQL} AS suppressed, {sql_level(LEVEL_TEXT_SQL)} AS level, "
     + ", ".join(f"{S.guard(ns(s), 0, 100)} AS {k}" for k, s in _EL.items()),
     B_IDS + ["suppressed"], ["level", *_EL], [(f"'english_learner_{k}_' || level", k) for k in _EL],
     [(f"'english_learner_{k}_' || level",) for k in _EL])


# 4. kindergarten readiness: count format (>= 1998) and percent format -----------
def _kg_prep(w):
    rwi, r, rwe = n("a_count"), n("n_count"), n("r_count")
    prior = F.when(suppk() % 2 == 1, F.lit("Child Care")).otherwise(F.lit("All Students"))
    counts = F.substring("school_year", 5, 4) >= "1998"
    # only the rate, the total ready or all three parts count as data, not the number tested
    flag = C.override_suppression(_flag(), [F.when(counts, rwi + r).otherwise(C.range_guard(n("r_rate"), 0, 100))])
    return w.select(*W_IDS, flag.alias("suppressed"), counts.alias("count_format"), (~counts).alias("percent_file"),
                    (C.slugify(prior) == "all_students").alias("prior_all"), C.slugify(prior).alias("prior_slug"),
                    (F.lower(F.trim("demographic")) == "all students").alias("demo_all"),
                    rwi.alias("rwi"), r.alias("rdy"), rwe.alias("rwe"), (rwi + r + rwe).alias("tested"),
                    (rwi + r).alias("ready"), F.when(~counts, C.range_guard(n("r_rate"), 0, 100)).alias("pct"),
                    n("total_count").alias("number_tested"))


_KG_ORACLE_DEFAULTS = ["kindergarten_readiness_rate", "kindergarten_readiness_count", "kindergarten_readiness_total",
                       "kindergarten_ready_with_interventions_count", "kindergarten_ready_with_interventions_rate",
                       "kindergarten_ready_count", "kindergarten_ready_rate",
                       "kindergarten_ready_with_enrichments_count", "kindergarten_ready_with_enrichments_rate"]


_kg_prior = f"CASE WHEN {SUPPK_SQL} % 2 = 1 THEN 'Child Care' ELSE 'All Students' END"
_kg_has = (f"CASE WHEN substr(school_year, 5, 4) >= '1998' THEN {ns('a_count')} + {ns('n_count')} "
           f"ELSE {S.guard(ns('r_rate'), 0, 100)} END IS NOT NULL")
_kg_flag = f"CASE WHEN {FLAG_SQL} = 'Y' AND {_kg_has} THEN 'N' ELSE {FLAG_SQL} END"
_kg_prep_sql = (f"{IDS_SQL}, {_kg_flag} AS suppressed, substr(school_year, 5, 4) >= '1998' AS count_format, "
                f"{sql_slug(_kg_prior)} = 'all_students' AS prior_all, {sql_slug(_kg_prior)} AS prior_slug, "
                f"lower(trim(demographic)) = 'all students' AS demo_all, {ns('a_count')} AS rwi, {ns('n_count')} AS rdy, "
                f"{ns('r_count')} AS rwe, {ns('a_count')} + {ns('n_count')} + {ns('r_count')} AS tested, "
                f"{ns('a_count')} + {ns('n_count')} AS ready, CASE WHEN NOT (substr(school_year, 5, 4) >= '1998') "
                f"THEN {S.guard(ns('r_rate'), 0, 100)} END AS pct, {ns('total_count')} AS number_tested")
_C, _A, _D = "count_format", "prior_all", "(NOT prior_all AND demo_all)"
_P = "(NOT count_format)"
_EST = "round_even(pct / 100 * number_tested, 0)"
_kg_sql_entries = []
for _nm, _col in [("ready_with_interventions", "rwi"), ("ready", "rdy"), ("ready_with_enrichments", "rwe")]:
    _kg_sql_entries.append((f"'kindergarten_{_nm}_count'", _col, f"{_C} AND {_A} AND tested IS NOT NULL"))
    _kg_sql_entries.append((f"'kindergarten_{_nm}_rate'", f"{_col} / tested * 100", f"{_C} AND {_A} AND tested > 0"))
_kg_sql_entries += [
    ("'kindergarten_readiness_count'", "ready", f"{_C} AND {_A} AND ready IS NOT NULL"),
    ("'kindergarten_readiness_total'", "tested", f"{_C} AND {_A} AND ready IS NOT NULL"),
    ("'kindergarten_readiness_rate'", "ready / tested * 100", f"{_C} AND {_A} AND ready IS NOT NULL AND tested > 0"),
    ("'kindergarten_' || prior_slug || '_count'", "ready", f"{_C} AND {_D} AND ready IS NOT NULL"),
    ("'kindergarten_' || prior_slug || '_rate'", "ready / tested * 100", f"{_C} AND {_D} AND ready IS NOT NULL AND tested > 0"),
    ("'kindergarten_readiness_rate'", "pct", f"{_P} AND {_A} AND pct IS NOT NULL"),
    ("'kindergarten_readiness_total'", "number_tested", f"{_P} AND {_A} AND number_tested IS NOT NULL"),
    ("'kindergarten_readiness_count'", _EST, f"{_P} AND {_A} AND number_tested IS NOT NULL AND pct IS NOT NULL"),
    ("'kindergarten_' || prior_slug || '_rate'", "pct", f"{_P} AND {_D} AND number_tested IS NOT NULL AND pct IS NOT NULL"),
    ("'kindergarten_' || prior_slug || '_count'", _EST, f"{_P} AND {_D} AND number_tested IS NOT NULL AND pct IS NOT NULL")]
_job("job_kindergarten", "W", _kg_prep, kindergarten_entries, kindergarten_defaults, "row",
     _kg_prep_sql, W_IDS + ["suppressed"],
     ["count_format", "prior_all", "prior_slug", "demo_all", "rwi", "rdy", "rwe", "tested", "ready", "pct", "number_tested"],
     _kg_sql_entries, [*((f"'{m}'",) for m in _KG_ORACLE_DEFAULTS),
                       *((f"'kindergarten_' || prior_slug || '_{k}'", f"{_P} AND {_D}") for k in ("rate", "count"))])

# 5. out-of-school suspension: metric-level suppression ----------------------------
# Two formats: from 1998 on (fixture years) the four parts and their totals, before one count;
# the in-school trio and nine further counts stand in both.
_OSS = "out_of_school_suspension_"
# Metric names of the source.
_SUSP_NEW = [f"{_OSS}single_with_disabilities_count", f"{_OSS}single_without_disabilities_count",
             f"{_OSS}multiple_with_disabilities_count", f"{_OSS}multiple_without_disabilities_count",
             f"{_OSS}single_total_count", f"{_OSS}multiple_total_count", f"{_OSS}total_count"]
_SUSP_OLD = [f"{_OSS}count"]
_SUSP_BOTH = ["in_school_suspension_with_disabilities_count", "in_school_suspension_without_disabilities_count", "in_school_suspension_total_count",
              "expelled_receiving_services_count", "expelled_not_receiving_services_count", "corporal_punishment_count", "in_school_removal_count",
              "restraint_count", "seclusion_count", "unilateral_removal_count", "removal_by_hearing_officer_count", "discipline_resolution_total_count"]


def _susp_prep(w):
    swd, swod, mwd, mwod = n("a_count"), n("n_count"), n("r_count"), n("part_0")
    old = F.substring("school_year", 5, 4) < "1998"
    flag = F.when(old, C.infer_suppression(n("total_count"), None)).otherwise(_flag())
    single, multiple = D.sum_null_as_zero([swd, swod]), D.sum_null_as_zero([mwd, mwod])
    new = [swd, swod, mwd, mwod, single, multiple, single + multiple]
    both = [n("part_1"), n("part_2"), D.sum_null_as_zero([n("part_1"), n("part_2")]), *(n(f"part_{i}") for i in range(3, 12))]
    values = dict(zip([*_SUSP_NEW, *_SUSP_OLD, *_SUSP_BOTH], [*new, n("total_count"), *both]))
    return w.select(*W_IDS, flag.alias("suppressed"), old.alias("old_format"), *[v.alias(m) for m, v in values.items()])


def _susp_entries():
    old = F.col("old_format")
    return [*(Entry(m, F.col(m), ~old) for m in _SUSP_NEW), *(Entry(m, F.col(m), old) for m in _SUSP_OLD),
            *(Entry(m, F.col(m), F.lit(True)) for m in _SUSP_BOTH)]


_z = lambda *parts: "(" + " + ".join(f"COALESCE({ns(p)}, 0.0)" for p in parts) + ")"
# the oracle's own list: (metric, value, in which format)
_SUSP_ORACLE = [
    ("out_of_school_suspension_single_with_disabilities_count", ns("a_count"), "NOT old_format"),
    ("out_of_school_suspension_single_without_disabilities_count", ns("n_count"), "NOT old_format"),
    ("out_of_school_suspension_multiple_with_disabilities_count", ns("r_count"), "NOT old_format"),
    ("out_of_school_suspension_multiple_without_disabilities_count", ns("part_0"), "NOT old_format"),
    ("out_of_school_suspension_single_total_count", _z("a_count", "n_count"), "NOT old_format"),
    ("out_of_school_suspension_multiple_total_count", _z("r_count", "part_0"), "NOT old_format"),
    ("out_of_school_suspension_total_count", f"({_z('a_count', 'n_count')} + {_z('r_count', 'part_0')})", "NOT old_format"),
    ("out_of_school_suspension_count", ns("total_count"), "old_format"),
    ("in_school_suspension_with_disabilities_count", ns("part_1"), "TRUE"),
    ("in_school_suspension_without_disabilities_count", ns("part_2"), "TRUE"),
    ("in_school_suspension_total_count", _z("part_1", "part_2"), "TRUE"),
    ("expelled_receiving_services_count", ns("part_3"), "TRUE"),
    ("expelled_not_receiving_services_count", ns("part_4"), "TRUE"),
    ("corporal_punishment_count", ns("part_5"), "TRUE"),
    ("in_school_removal_count", ns("part_6"), "TRUE"),
    ("restraint_count", ns("part_7"), "TRUE"),
    ("seclusion_count", ns("part_8"), "TRUE"),
    ("unilateral_removal_count", ns("part_9"), "TRUE"),
    ("removal_by_hearing_officer_count", ns("part_10"), "TRUE"),
    ("discipline_resolution_total_count", ns("part_11"), "TRUE"),
]
_susp_flag = (f"CASE WHEN substr(school_year, 5, 4) < '1998' THEN CASE WHEN {ns('total_count')} IS NULL "
              f"THEN 'Y' ELSE 'N' END ELSE {FLAG_SQL} END")
_job("job_suspension", "W", _susp_prep, _susp_entries,
     lambda: [Entry(e.metric, F.lit(None).cast("double"), e.keep) for e in _susp_entries()], "metric",
     f"{IDS_SQL}, {_susp_flag} AS suppressed, substr(school_year, 5, 4) < '1998' AS old_format, "
     + ", ".join(f"{v} AS {m}" for m, v, _ in _SUSP_ORACLE),
     W_IDS + ["suppressed"], ["old_format", *(m for m, _, _ in _SUSP_ORACLE)], [(f"'{m}'", m, k) for m, _, k in _SUSP_ORACLE],
     [(f"'{m}'", k) for m, _, k in _SUSP_ORACLE])

# 6. postsecondary enrollment: all seven keys always extracted ----------------------
_PSE = "postsecondary_enrollment_"


def _pse_prep(w):
    cohort, pub, priv = n("total_count"), n("a_count"), n("r_count")
    tot = pub + priv
    pos = cohort > 0
    return w.select(*W_IDS, _flag().alias("suppressed"), cohort.alias("cohort"), pub.alias("pub"), priv.alias("priv"),
                    tot.alias("tot"), C.range_guard(n("r_rate"), 0, 100).alias("pub_rate"),
                    F.when(pos, F.bround(F.try_divide(priv, cohort) * 100, 1)).alias("priv_rate"),
                    F.when(pos, F.bround(F.try_divide(tot, cohort) * 100, 1)).alias("tot_rate"))


# Metric names of the source, after the prefix.
_PSE_COLS = {"total_in_cohort": "cohort", "public_ky_college_count": "pub", "private_ky_college_count": "priv", "total_ky_college_count": "tot",
             "public_ky_college_rate": "pub_rate", "private_ky_college_rate": "priv_rate", "total_ky_college_rate": "tot_rate"}
_PSE_ORACLE = [("postsecondary_enrollment_total_in_cohort", "cohort"), ("postsecondary_enrollment_public_ky_college_count", "pub"),
               ("postsecondary_enrollment_private_ky_college_count", "priv"), ("postsecondary_enrollment_total_ky_college_count", "tot"),
               ("postsecondary_enrollment_public_ky_college_rate", "pub_rate"), ("postsecondary_enrollment_private_ky_college_rate", "priv_rate"),
               ("postsecondary_enrollment_total_ky_college_rate", "tot_rate")]
_pse_cohort, _pse_pub, _pse_priv = ns("total_count"), ns("a_count"), ns("r_count")
_pse_prep_sql = (f"{IDS_SQL}, {FLAG_SQL} AS suppressed, {_pse_cohort} AS cohort, {_pse_pub} AS pub, {_pse_priv} AS priv, "
                 f"{_pse_pub} + {_pse_priv} AS tot, {S.guard(ns('r_rate'), 0, 100)} AS pub_rate, "
                 f"CASE WHEN {_pse_cohort} > 0 THEN round_even({_pse_priv} / {_pse_cohort} * 100, 1) END AS priv_rate, "
                 f"CASE WHEN {_pse_cohort} > 0 THEN round_even(({_pse_pub} + {_pse_priv}) / {_pse_cohort} * 100, 1) END AS tot_rate")
_job("job_postsec_enrollment", "W", _pse_prep,
     lambda: [Entry(_PSE + k, F.col(c), F.lit(True)) for k, c in _PSE_COLS.items()],
     lambda: [_PSE + k for k in _PSE_COLS], "row", _pse_prep_sql, W_IDS + ["suppressed"], list(_PSE_COLS.values()),
     [(f"'{m}'", c, "TRUE") for m, c in _PSE_ORACLE], [(f"'{m}'",) for m, _ in _PSE_ORACLE])


# 7. postsecondary readiness: both rates always ------------------------------------
JOB_SQL["job_postsec_readiness"] = _ae[1]
JOB_SPECS["job_postsec_readiness"] = always_spec, "W"


@register("job_postsec_readiness", _ae[0] + _ae[1])
def job_postsec_readiness_q(spark, sf):
    return run_spec(always_spec(), _w(spark, sf), W_DIMS)


# 8. assessment: bands, combined, content index x grade and level ------------------
_KSA_RATES = {"novice_rate": "novice", "apprentice_rate": "apprentice", "proficient_rate": "proficient",
              "distinguished_rate": "distinguished"}


def _ksa_prep(b):
    grade = L.normalize_grade("grade")
    bands = {k: C.range_guard(n(s), 0, 100) for k, s in _KSA_RATES.items()}
    combined = C.range_guard(bands["proficient_rate"] + bands["distinguished_rate"], 0, 100)
    index = C.range_guard(bands["apprentice_rate"] * 0.5 + bands["proficient_rate"] + bands["distinguished_rate"] * 1.25, 0)
    return b.select(*B_IDS, _flag().alias("suppressed"), L.normalize_subject("subject").alias("subject_n"),
                    grade.alias("grade_n"),
                    F.when(grade != "all_grades", L.grade_to_level(grade)).otherwise(F.lit("all")).alias("level_n"),
                    *[v.alias(k) for k, v in bands.items()], combined.alias("proficient_distinguished_rate"),
                    index.alias("content_index_score"))


_kg = sql_grade("grade")
_ksa_b = {k: S.guard(ns(s), 0, 100) for k, s in _KSA_RATES.items()}
_ksa_prep_sql = (f"{', '.join(B_IDS)}, {FLAG_SQL} AS suppressed, {sql_subject('subject')} AS subject_n, {_kg} AS grade_n, "
                 f"CASE WHEN {_kg} <> 'all_grades' THEN {sql_grade_to_level(_kg)} ELSE 'all' END AS level_n, "
                 + ", ".join(f"{v} AS {k}" for k, v in _ksa_b.items())
                 + f", {S.guard(_ksa_b['proficient_rate'] + ' + ' + _ksa_b['distinguished_rate'], 0, 100)} AS proficient_distinguished_rate, "
                 f"{S.guard(_ksa_b['apprentice_rate'] + ' * 0.5 + ' + _ksa_b['proficient_rate'] + ' + ' + _ksa_b['distinguished_rate'] + ' * 1.25', 0)} AS content_index_score")
_KSA_ORACLE = ["novice_rate", "apprentice_rate", "proficient_rate", "distinguished_rate", "proficient_distinguished_rate", "content_index_score"]
_ksa_sql_entries = []
for _k in _KSA_ORACLE:
    _ksa_sql_entries.append((f"'kentucky_summative_assessment_' || subject_n || '_{_k}_' || grade_n", _k, f"{_k} IS NOT NULL AND grade_n <> 'all_grades'"))
    _ksa_sql_entries.append((f"'kentucky_summative_assessment_' || subject_n || '_{_k}_' || level_n", _k, f"{_k} IS NOT NULL AND level_n <> 'all'"))
_job("job_assessment", "B", _ksa_prep, assessment_entries, assessment_defaults, "row", _ksa_prep_sql, B_IDS + ["suppressed"],
     ["subject_n", "grade_n", "level_n", *_KSA_ORACLE], _ksa_sql_entries,
     [(f"'kentucky_summative_assessment_' || subject_n || '_{k}_' || {p}_n", f"{p}_n <> '{none}'")
      for k in _KSA_ORACLE
      for p, none in (("grade", "all_grades"), ("level", "all"))])


# 9. CTE participation: rate or count, guarded after the decision --------------------
def _cte_prep(w):
    part = F.when(suppk() % 2 == 0, n("r_rate")).otherwise(n("qty_text"))
    total = n("qty_text") * 2
    p_rate, p_count = D.rate_or_count(part, total)
    elig = n("a_count")
    c_rate, c_count = D.rate_or_count(n("n_count"), elig)
    return w.select(*W_IDS, _flag().alias("suppressed"), C.range_guard(p_rate, 0, 100).alias("p_rate"),
                    p_count.alias("p_count"), elig.alias("elig"), C.range_guard(c_rate, 0, 100).alias("c_rate"),
                    c_count.alias("c_count"))


_CTE = {"cte_participation_rate": "p_rate", "cte_participation_count": "p_count",
        "cte_eligible_completer_count_grade_12": "elig", "cte_completion_rate_grade_12": "c_rate",
        "cte_completion_count_grade_12": "c_count"}


def _roc_sql(v, t):
    rate = f"CASE WHEN {v} <= 100 THEN {v} WHEN {v} > 100 AND {t} > 0 THEN round_even({v} / ({t}) * 100, 1) END"
    count = f"CASE WHEN {v} > 100 AND NOT COALESCE({t} > 0, FALSE) THEN {v} END"
    return rate, count


_cte_part = f"CASE WHEN {SUPPK_SQL} % 2 = 0 THEN {ns('r_rate')} ELSE {ns('qty_text')} END"
_pr, _pc = _roc_sql(_cte_part, f"{ns('qty_text')} * 2")
_cr, _cc = _roc_sql(ns("n_count"), ns("a_count"))
_job("job_cte", "W", _cte_prep, lambda: [Entry(m, F.col(c)) for m, c in _CTE.items()],
     lambda: list(_CTE), "row",
     f"{IDS_SQL}, {FLAG_SQL} AS suppressed, {S.guard(_pr, 0, 100)} AS p_rate, {_pc} AS p_count, {ns('a_count')} AS elig, "
     f"{S.guard(_cr, 0, 100)} AS c_rate, {_cc} AS c_count", W_IDS + ["suppressed"], list(_CTE.values()),
     [(f"'{m}'", c) for m, c in _CTE.items()],
     [(f"'{m}'",) for m in ["cte_participation_rate", "cte_participation_count", "cte_eligible_completer_count_grade_12",
                            "cte_completion_rate_grade_12", "cte_completion_count_grade_12"]])

# 10. student enrollment: row policy, then positives only --------------------------
_SE = "student_enrollment_"
# Grades of the source in order, and which grades make a school level.
_ENR_GRADES = ["preschool", "kindergarten", *(f"grade_{i}" for i in range(1, 13)), "grade_14"]
_ENR_LEVELS = {"primary": _ENR_GRADES[0:7], "middle": _ENR_GRADES[7:10], "secondary": _ENR_GRADES[10:14]}
_ENR_METRICS = ["total", *_ENR_GRADES, *_ENR_LEVELS]


def _enr_prep(w):
    grades = {g: n(f"part_{i}") for i, g in enumerate(_ENR_GRADES)}
    return w.select(*W_IDS, _flag().alias("suppressed"),
                    D.first_nonzero_total(F.lit(None).cast("double"), n("total_count")).alias("e_total"),
                    *[v.alias(f"e_{g}") for g, v in grades.items()],
                    *[D.sum_positive_or_null([grades[g] for g in own]).alias(f"e_{level}") for level, own in _ENR_LEVELS.items()])


def _positive_sum_sql(first: int, last: int) -> str:
    parts = [ns(f"part_{i}") for i in range(first, last + 1)]
    total = " + ".join(f"CASE WHEN {p} > 0 THEN {p} ELSE 0.0 END" for p in parts)
    return f"NULLIF({total}, 0.0)"


# the oracle's own list: metric -> value
_ENR_ORACLE = [("student_enrollment_total", f"CASE WHEN {ns('total_count')} > 0 THEN {ns('total_count')} END"),
               ("student_enrollment_preschool", ns("part_0")), ("student_enrollment_kindergarten", ns("part_1")),
               *((f"student_enrollment_grade_{g}", ns(f"part_{g + 1}")) for g in range(1, 13)),
               ("student_enrollment_grade_14", ns("part_14")),
               ("student_enrollment_primary", _positive_sum_sql(0, 6)),
               ("student_enrollment_middle", _positive_sum_sql(7, 9)),
               ("student_enrollment_secondary", _positive_sum_sql(10, 13))]
_job("job_enrollment", "W", _enr_prep, lambda: [Entry(_SE + m, F.col(f"e_{m}"), F.col(f"e_{m}") > 0) for m in _ENR_METRICS],
     lambda: [_SE + m for m in _ENR_METRICS], "row",
     f"{IDS_SQL}, {FLAG_SQL} AS suppressed, " + ", ".join(f"{v} AS {m}" for m, v in _ENR_ORACLE), W_IDS + ["suppressed"],
     [m for m, _ in _ENR_ORACLE], [(f"'{m}'", m, f"{m} > 0") for m, _ in _ENR_ORACLE], [(f"'{m}'",) for m, _ in _ENR_ORACLE])


# 11. safe-schools discipline: positive counts, integer-truncated -------------------
# Count columns of the source.
_DISC = ["corporal_punishment_count", "restraint_count", "seclusion_count", "expelled_not_receiving_services_count",
         "expelled_receiving_services_count", "in_school_removal_count", "out_of_school_suspension_count",
         "removal_by_hearing_officer_count", "unilateral_removal_count", "arrest_count", "charges_count",
         "civil_proceedings_count", "court_designated_worker_count", "school_resource_officer_count"]
_DISC_ORACLE = """corporal_punishment_count restraint_count seclusion_count expelled_not_receiving_services_count
expelled_receiving_services_count in_school_removal_count out_of_school_suspension_count removal_by_hearing_officer_count
unilateral_removal_count arrest_count charges_count civil_proceedings_count court_designated_worker_count
school_resource_officer_count""".split()
_job("job_discipline", "W",
     lambda w: w.select(*W_IDS, _flag().alias("suppressed"),
                        *[n(f"part_{i}").cast("bigint").cast("double").alias(m) for i, m in enumerate(_DISC)]),
     lambda: [Entry(m, F.col(m), F.col(m) > 0) for m in _DISC], lambda: list(_DISC), "row",
     f"{IDS_SQL}, {FLAG_SQL} AS suppressed, " + ", ".join(f"trunc({ns(f'part_{i}')}) AS {m}" for i, m in enumerate(_DISC_ORACLE)),
     W_IDS + ["suppressed"], _DISC_ORACLE, [(f"'{m}'", m, f"{m} > 0") for m in _DISC_ORACLE], [(f"'{m}'",) for m in _DISC_ORACLE])
