"""Source jobs end to end over CSV deliveries with the sources' headers: the
wide fixture is written as exports (years before 1998 in the historical
spelling), scanned, renamed, and must give the rows of the fixture's job."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.operators.columns import COMMON_HEADERS
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.exports import EXPORTS, GRADES, export_job
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_jobs import JOB_SQL
from kpiloom.plans.q_normalize import level_text
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import W_IDS
from kpiloom.session import scratch_path
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

CSV = {"header": "true", "quote": '"', "escape": '"'}
SUSPENSION_BOTH = ["in_school_with_disabilities", "in_school_without_disabilities", "expelled_receiving_services", "expelled_not_receiving_services",
                   "corporal_punishment", "in_school_removal", "restraint", "seclusion", "unilateral_removal", "removal_by_hearing_officer",
                   "total_discipline_resolutions"]


def _private_rate():
    return _share(C.parse_number("r_count"))


def _enrolled():
    return C.parse_number("a_count") + C.parse_number("r_count")


def _share(part):
    total = C.parse_number("total_count")
    return F.when(total > 0, F.bround(F.try_divide(part, total) * 100, 1))


def _prior():
    return F.when(F.col("school_code").cast("bigint") % 2 == 1, "Child Care").otherwise("All Students")


def _ready():
    return C.parse_number("a_count") + C.parse_number("n_count")


def _proficient_distinguished():
    return C.parse_number("proficient") + C.parse_number("distinguished")


def _content_index():
    return C.parse_number("apprentice") * 0.5 + C.parse_number("proficient") + C.parse_number("distinguished") * 1.25


# canonical column of the source -> column of the fixture, or a function that gives one; where the
# historical files deliver other columns, two such lists
BINDINGS = {
    "graduation_rates": {"suppressed_4_year": "suppressed", "suppressed_5_year": "suppressed", "graduation_rate_4_year": "r_rate", "grads_4_year_cohort": "r_count",
                         "students_4_year_cohort": "total_count", "graduation_rate_5_year": "a_rate", "grads_5_year_cohort": "a_count",
                         "students_5_year_cohort": "total_count"},
    "student_enrollment": {"suppressed": "suppressed", "total_student_count": "total_count", **{g: f"part_{i}" for i, g in enumerate(GRADES)}},
    "safe_schools_discipline": {"suppressed": "suppressed", **{c: f"part_{i}" for i, c in enumerate(EXPORTS["safe_schools_discipline"].headers)}},
    "chronic_absenteeism": {"suppressed": "suppressed", "grade": lambda: F.concat(F.lit("Grade "), F.substring("school_year", 8, 1)),
                            "chronic_absenteeism_rate": "r_rate", "chronically_absent_count": "r_count", "enrollment_count": "qty_text"},
    "english_learner_progress": {"suppressed": "suppressed", "level": level_text, "percentage_score_0": "novice", "percentage_score_60_80": "apprentice",
                                 "percentage_score_100": "proficient", "percentage_score_140": "distinguished"},
    "postsecondary_readiness": {"suppressed": "suppressed", "postsecondary_rate": "r_rate",
                                "postsecondary_rate_with_bonus": lambda: C.parse_number("r_rate") * 1.3},
    "postsecondary_enrollment": {"suppressed": "suppressed", "total_in_group": "total_count", "public_college_enrolled": "a_count",
                                 "private_college_enrolled": "r_count", "college_enrolled_total": _enrolled, "public_college_rate": "r_rate",
                                 "private_college_rate": _private_rate, "college_enrollment_rate": lambda: _share(_enrolled())},
    "cte_participation": {"suppressed": "suppressed", "cte_eligible_completer_count": "a_count", "cte_completion_rate": "n_count",
                          "cte_participation_rate": lambda: F.when(F.col("school_code").cast("bigint") % 2 == 0, F.col("r_rate")).otherwise(F.col("qty_text")),
                          "total_student_count": lambda: C.parse_number("qty_text") * 2},
    "kindergarten_readiness": (
        {"suppressed": "suppressed", "prior_setting": _prior, "total_percent_ready": "r_rate", "number_tested": "total_count"},
        {"suppressed": "suppressed", "prior_setting": _prior, "ready_with_interventions_count": "a_count", "ready_count": "n_count",
         "ready_with_enrichments_count": "r_count", "total_ready_count": _ready}),
    "kentucky_summative_assessment": {"suppressed": "suppressed", "subject": "subject", "grade": "grade",
                                      **{c: c for c in ("novice", "apprentice", "proficient", "distinguished")},
                                      "proficient_distinguished": _proficient_distinguished, "content_index": _content_index},
    "out_of_school_suspension": (
        {"out_of_school_suspension": "total_count", **{c: f"part_{i}" for i, c in enumerate(SUSPENSION_BOTH, 1)}},
        {"suppressed": "suppressed", "single_out_of_school_with_disabilities": "a_count", "single_out_of_school_without_disabilities": "n_count",
         "multiple_out_of_school_with_disabilities": "r_count", "multiple_out_of_school_without_disabilities": "part_0",
         **{c: f"part_{i}" for i, c in enumerate(SUSPENSION_BOTH, 1)}}),
}
FIXTURES = {"english_learner_progress": fixtures.bands, "kentucky_summative_assessment": fixtures.bands}


def write_exports(spark, sf: str, source: str, stem: str) -> str:
    """One folder a year, named like the file of the fixture's job."""
    root = scratch_path(spark, f"export-{source}")
    w = FIXTURES.get(source, fixtures.wide_parts)(Tables(spark, sf))
    year = F.substring("school_year", 5, 4)
    delivery = F.concat(F.lit(f"{stem}_"), year, F.lit(".csv")).alias("delivery")
    headers = {**COMMON_HEADERS, **EXPORTS[source].headers}
    bindings = BINDINGS[source]
    for old in (True, False):
        own = bindings[not old] if isinstance(bindings, tuple) else bindings
        columns = {**{c: c for c in W_IDS}, **own}
        part = w.filter((year < "1998") if old else (year >= "1998"))
        named = [(F.col(given) if isinstance(given, str) else given()).alias(headers[c][-1 if old else 0]) for c, given in columns.items()]
        part.select(*named, delivery).hint("rebalance", "delivery").write.mode("append").options(**CSV).partitionBy("delivery").csv(root)
    return root


def _register(key: str, source: str, job: str, cte: str | None = None, stem: str | None = None) -> None:
    @register(key, ctes(f"{cte or job}_map") + JOB_SQL[job])
    def query(spark, sf):
        return export_job(spark, source, f"{write_exports(spark, sf, source, stem or job)}/*/*.csv", W_DIMS, level="folder")


_register("export_graduation", "graduation_rates", "job_graduation")
_register("export_enrollment", "student_enrollment", "job_enrollment")
_register("export_discipline", "safe_schools_discipline", "job_discipline")
_register("export_absenteeism", "chronic_absenteeism", "job_absenteeism")
_register("export_english_learner", "english_learner_progress", "job_english_learner")
_register("export_postsec_readiness", "postsecondary_readiness", "job_postsec_readiness", "ae", "source")
_register("export_postsec_enrollment", "postsecondary_enrollment", "job_postsec_enrollment")
_register("export_cte", "cte_participation", "job_cte")
_register("export_suspension", "out_of_school_suspension", "job_suspension")
_register("export_kindergarten", "kindergarten_readiness", "job_kindergarten")
_register("export_assessment", "kentucky_summative_assessment", "job_assessment")
