"""Source jobs over real exports: a folder of CSV files with the source's own
headers -> scan by header group -> canonical columns -> spec -> KPI rows.

``EXPORTS`` names each source's headers, its measures by canonical column and
its spec.  A source may have several families, each with a suppression flag of
its own (graduation: 4-year and 5-year cohort); every family is one spec over
the same scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.functions import labels as L
from kpiloom.operators.columns import COMMON_HEADERS, rename_columns
from kpiloom.operators.demographics import DemographicDims
from kpiloom.operators.longform import Entry
from kpiloom.plans.entries import assessment_defaults, assessment_entries, kindergarten_defaults, kindergarten_entries
from kpiloom.plans.specs import SourceSpec, run_spec
from kpiloom.schema import ID_PASSTHROUGH
from kpiloom.sources import csv_io as IO

# Canonical measure columns and the header spellings of each source.
GRADUATION_HEADERS = {
    "suppressed_4_year": ["Suppressed", "SUPPRESSED 4 YEAR", "Suppressed 4 Year"],
    "suppressed_5_year": ["SUPPRESSED 5 YEAR"],
    "graduation_rate_4_year": ["4 Year Cohort Graduation Rate", "4-YEAR GRADUATION RATE"],
    "graduation_rate_5_year": ["5-YEAR GRADUATION RATE"],
    "grads_4_year_cohort": ["NUMBER OF GRADS IN 4-YEAR COHORT"],
    "students_4_year_cohort": ["NUMBER OF STUDENTS IN 4-YEAR COHORT"],
    "grads_5_year_cohort": ["NUMBER OF GRADS IN 5-YEAR COHORT"],
    "students_5_year_cohort": ["NUMBER OF STUDENTS IN 5-YEAR COHORT"],
}
POSTSECONDARY_ENROLLMENT_HEADERS = {
    "total_in_group": ["Total In Group", "TOTAL IN GROUP"],
    "public_college_enrolled": ["Public College Enrolled In State", "PUBLIC COLLEGE ENROLLED IN STATE"],
    "private_college_enrolled": ["Private College Enrolled In State", "PRIVATE COLLEGE ENROLLED IN STATE"],
    "college_enrolled_total": ["College Enrolled In State", "COLLEGE ENROLLED IN STATE"],
    "public_college_rate": ["Percentage Public College Enrolled In State", "PERCENTAGE PUBLIC COLLEGE ENROLLED IN STATE"],
    "private_college_rate": ["Percentage Private College Enrolled In State", "PERCENTAGE PRIVATE COLLEGE ENROLLED IN STATE"],
    "college_enrollment_rate": ["Percentage College Enrolled In State", "PERCENTAGE COLLEGE ENROLLED IN STATE",
                                "Percentage College Enrolled In State Table"],
}
CTE_HEADERS = {
    "cte_participation_rate": ["CTE Participants in All Grades", "CTE PARTICIPANTS IN ALL GRADES"],
    "cte_eligible_completer_count": ["Grade 12 CTE Eligible Completer", "GRADE 12 CTE ELIGIBLE COMPLETER"],
    "cte_completion_rate": ["Grade 12 CTE Completers", "GRADE 12 CTE COMPLETERS"],
    "total_student_count": ["Total Number of Student", "TOTAL NUMBER OF STUDENT"],
}
GRADES = ["preschool", "k", *(f"grade_{i}" for i in range(1, 13)), "grade_14"]
ENROLLMENT_HEADERS = {
    "all_grades": ["All Grades"],
    "total_student_count": ["TOTAL STUDENT COUNT"],
    "preschool": ["Preschool", "PRESCHOOL COUNT"],
    "k": ["K", "KINDERGARTEN COUNT"],
    **{f"grade_{i}": [f"Grade {i}", f"GRADE{i} COUNT"] for i in [*range(1, 13), 14]},
}
DISCIPLINE_HEADERS = {
    "corporal_punishment_count": ["Corporal Punishment (SSP5)", "CORPORAL PUNISHMENT SSP5"],
    "restraint_count": ["Restraint (SSP7)", "RESTRAINT SSP7"],
    "seclusion_count": ["Seclusion (SSP8)", "SECLUSION SSP8"],
    "expelled_not_receiving_services_count": ["Expelled, Not Receiving Services (SSP2)", "EXPELLED NOT RECEIVING SERVICES SSP2"],
    "expelled_receiving_services_count": ["Expelled, Receiving Services (SSP1)", "EXPELLED RECEIVING SERVICES SSP1"],
    "in_school_removal_count": ["In-School Removal (INSR) Or In-District Removal (INDR) >=.5", "IN-SCHOOL REMOVAL INSR"],
    "out_of_school_suspension_count": ["Out-Of-School Suspensions (SSP3)", "OUT OF SCHOOL SUSPENSION SSP3"],
    "removal_by_hearing_officer_count": ["Removal By Hearing Officer (IAES2)", "REMOVAL BY HEARING OFFICER IAES2"],
    "unilateral_removal_count": ["Unilateral Removal By School Personnel (IAES1)", "UNILATERAL REMOVAL BY SCHOOL PERSONNEL IAES1"],
    "arrest_count": ["Arrests"],
    "charges_count": ["Charges"],
    "civil_proceedings_count": ["Civil Proceedings"],
    "court_designated_worker_count": ["Court Designated Worker Involvement"],
    "school_resource_officer_count": ["School Resource Officer Involvement"],
}
SUSPENSION_HEADERS = {
    "single_out_of_school_with_disabilities": ["Single Out-of-School With Disabilities"],
    "single_out_of_school_without_disabilities": ["Single Out-of-School Without Disabilities"],
    "multiple_out_of_school_with_disabilities": ["Multiple Out-of-School With Disabilities"],
    "multiple_out_of_school_without_disabilities": ["Multiple Out-of-School Without Disabilities"],
    "out_of_school_suspension": ["Out of School Suspension SSP3", "OUT OF SCHOOL SUSPENSION SSP3"],
    "in_school_with_disabilities": ["In-School With Disabilities"],
    "in_school_without_disabilities": ["In-School Without Disabilities"],
    "expelled_receiving_services": ["Expelled Receiving Services SSP1"],
    "expelled_not_receiving_services": ["Expelled Not Receiving Services SSP2"],
    "corporal_punishment": ["Corporal Punishment SSP5"],
    "in_school_removal": ["In-School Removal INSR"],
    "restraint": ["Restraint SSP7"],
    "seclusion": ["Seclusion SSP8"],
    "unilateral_removal": ["Unilateral Removal by School Personnel IAES1"],
    "removal_by_hearing_officer": ["Removal by Hearing Officer IAES2"],
    "total_discipline_resolutions": ["Total Discipline Resolutions"],
}
ABSENTEEISM_HEADERS = {
    "grade": ["Grade", "GRADE"],
    "chronic_absenteeism_rate": ["Chronic Absenteeism Rate", "PERCENT CHRONICALLY ABSENT"],
    "chronically_absent_count": ["Chronically Absent Students", "CHRONIC ABSENTEE COUNT"],
    "enrollment_count": ["Students Enrolled 10 or More Days", "ENROLLMENT COUNT OF STUDENTS WITH 10+ ENROLLED DAYS"],
}
ENGLISH_LEARNER_HEADERS = {
    "level": ["Level", "LEVEL"],
    "percentage_score_0": ["Percentage Of Value Table Score Of 0", "PERCENTAGE OF VALUE TABLE SCORE OF 0"],
    "percentage_score_60_80": ["Percentage Of Value Table Score Of 60 And 80", "PERCENTAGE OF VALUE TABLE SCORE OF 60 AND 80"],
    "percentage_score_100": ["Percentage Of Value Table Score Of 100", "PERCENTAGE OF VALUE TABLE SCORE OF 100"],
    "percentage_score_140": ["Percentage Of Value Table Score Of 140", "PERCENTAGE OF VALUE TABLE SCORE OF 140"],
}
POSTSECONDARY_READINESS_HEADERS = {
    "postsecondary_rate": ["Postsecondary Rate", "POSTSECONDARY RATE"],
    "postsecondary_rate_with_bonus": ["Postsecondary Rate With Bonus", "POSTSECONDARY RATE WITH BONUS"],
}
KINDERGARTEN_HEADERS = {
    "total_percent_ready": ["Total Percent Ready", "TOTAL PERCENT READY"],
    "ready_with_interventions_count": ["Ready With Interventions"],
    "ready_count": ["Ready"],
    "ready_with_enrichments_count": ["Ready With Enrichments"],
    "total_ready_count": ["Total Ready"],
    "number_tested": ["Number Tested", "NUMBER TESTED"],
    "prior_setting": ["Prior Setting", "PRIOR SETTING"],
}
ASSESSMENT_HEADERS = {
    "level": ["Level", "LEVEL"],
    "subject": ["Subject", "SUBJECT"],
    "grade": ["Grade", "GRADE"],
    "novice": ["Novice", "NOVICE"],
    "apprentice": ["Apprentice", "APPRENTICE"],
    "proficient": ["Proficient", "PROFICIENT"],
    "distinguished": ["Distinguished", "DISTINGUISHED"],
    "proficient_distinguished": ["Proficient / Distinguished", "PROFICIENT/DISTINGUISHED"],
    "content_index": ["Content Index", "CONTENT INDEX"],
}
# Output metric names, where they are not the canonical column's.
GRADUATION_METRICS = {y: {f"graduation_rate_{y}_year": f"graduation_rate_{y}_year", f"graduation_count_{y}_year": f"grads_{y}_year_cohort",
                          f"graduation_total_{y}_year": f"students_{y}_year_cohort"} for y in (4, 5)}
POSTSECONDARY_ENROLLMENT_METRICS = {
    "postsecondary_enrollment_total_in_cohort": "total_in_group",
    "postsecondary_enrollment_public_ky_college_count": "public_college_enrolled",
    "postsecondary_enrollment_private_ky_college_count": "private_college_enrolled",
    "postsecondary_enrollment_total_ky_college_count": "college_enrolled_total",
    "postsecondary_enrollment_public_ky_college_rate": "public_college_rate",
    "postsecondary_enrollment_private_ky_college_rate": "private_college_rate",
    "postsecondary_enrollment_total_ky_college_rate": "college_enrollment_rate",
}
SUSPENSION_PARTS = {f"out_of_school_suspension_{n}_{d}_disabilities_count": f"{n}_out_of_school_{d}_disabilities"
                    for n in ("single", "multiple") for d in ("with", "without")}
SUSPENSION_COUNTS = {"discipline_resolution_total_count": "total_discipline_resolutions",
                     **{f"{c}_count": c for c in ("expelled_receiving_services", "expelled_not_receiving_services", "corporal_punishment", "in_school_removal",
                                                  "restraint", "seclusion", "unilateral_removal", "removal_by_hearing_officer")}}

SOURCE_FILE = "_source_file"
IDS = ["school_year", "district_name", "school_name", "demographic", *ID_PASSTHROUGH, SOURCE_FILE]


@dataclass
class Export:
    headers: dict[str, list[str]]
    specs: Callable[[], list[SourceSpec]]


def _n(c: str) -> Column:
    return C.parse_number(c)


def _spec(name: str, measures: Callable[[], dict[str, Column]], entries: Callable[[], list[Entry]] | None = None,
          defaults: Callable[[], list[Entry | str]] | None = None, flag: Callable[[], Column] = lambda: C.suppression_flag("suppressed"),
          policy: str = "row") -> SourceSpec:
    """A spec whose typed columns are ``measures``; by default each is a metric and a suppressed default."""
    def prepare(df: DataFrame) -> DataFrame:
        return df.select(*IDS, flag().alias("suppressed"), *[v.alias(k) for k, v in measures().items()])

    return SourceSpec(name, prepare, entries or (lambda: [Entry(m, F.col(m)) for m in measures()]), defaults or (lambda: list(measures())),
                      policy, lambda: F.col(SOURCE_FILE))


def _graduation() -> list[SourceSpec]:
    def family(years: int) -> SourceSpec:
        names = GRADUATION_METRICS[years]
        return _spec(f"graduation_{years}_year", lambda: {m: C.range_guard(_n(c), 0, 100 if "_rate_" in m else None) for m, c in names.items()},
                     flag=lambda: C.suppression_flag(f"suppressed_{years}_year"))
    return [family(4), family(5)]


def _postsecondary_enrollment() -> list[SourceSpec]:
    names = POSTSECONDARY_ENROLLMENT_METRICS
    return [_spec("postsecondary_enrollment", lambda: {m: C.range_guard(_n(c), 0, 100) if m.endswith("_rate") else _n(c) for m, c in names.items()},
                  entries=lambda: [Entry(m, F.col(m), F.lit(True)) for m in names])]


def _cte() -> list[SourceSpec]:
    def measures() -> dict[str, Column]:
        eligible = C.range_guard(_n("cte_eligible_completer_count"), 0)
        p_rate, p_count = D.rate_or_count(_n("cte_participation_rate"), C.range_guard(_n("total_student_count"), 0))
        c_rate, c_count = D.rate_or_count(_n("cte_completion_rate"), eligible)
        return {"cte_participation_rate": C.range_guard(p_rate, 0, 100), "cte_participation_count": p_count, "cte_eligible_completer_count_grade_12": eligible,
                "cte_completion_rate_grade_12": C.range_guard(c_rate, 0, 100), "cte_completion_count_grade_12": c_count}
    return [_spec("cte_participation", measures)]


def _enrollment() -> list[SourceSpec]:
    levels = {"primary": GRADES[0:7], "middle": GRADES[7:10], "secondary": GRADES[10:14]}

    def measures() -> dict[str, Column]:
        out = {"total": D.first_nonzero_total(_n("all_grades"), _n("total_student_count"))}
        out |= {"kindergarten" if g == "k" else g: _n(g) for g in GRADES}
        out |= {level: D.sum_positive_or_null([_n(g) for g in own]) for level, own in levels.items()}
        return {f"student_enrollment_{k}": v for k, v in out.items()}
    return [_spec("student_enrollment", measures, entries=lambda: [Entry(m, F.col(m), F.col(m) > 0) for m in measures()])]


def _discipline() -> list[SourceSpec]:
    def measures() -> dict[str, Column]:
        return {c: _n(c).cast("bigint").cast("double") for c in DISCIPLINE_HEADERS}
    return [_spec("safe_schools_discipline", measures, entries=lambda: [Entry(m, F.col(m), F.col(m) > 0) for m in DISCIPLINE_HEADERS])]


def _suspension() -> list[SourceSpec]:
    """Two formats, told apart by the header: four parts with totals, or one count."""
    single, multiple = list(SUSPENSION_PARTS)[:2], list(SUSPENSION_PARTS)[2:]
    totals = ["out_of_school_suspension_single_total_count", "out_of_school_suspension_multiple_total_count", "out_of_school_suspension_total_count"]
    in_school = ["in_school_with_disabilities", "in_school_without_disabilities"]

    def measures() -> dict[str, Column]:
        parts = {m: _n(c) for m, c in SUSPENSION_PARTS.items()}
        one, many = D.sum_null_as_zero([parts[m] for m in single]), D.sum_null_as_zero([parts[m] for m in multiple])
        return {"parts_format": F.array_contains("_source_header", SUSPENSION_HEADERS["single_out_of_school_with_disabilities"][0]),
                **parts, **dict(zip(totals, [one, many, one + many])), "out_of_school_suspension_count": _n("out_of_school_suspension"),
                "in_school_suspension_with_disabilities_count": _n(in_school[0]), "in_school_suspension_without_disabilities_count": _n(in_school[1]),
                "in_school_suspension_total_count": D.sum_null_as_zero([_n(c) for c in in_school]),
                **{m: _n(c) for m, c in SUSPENSION_COUNTS.items()}}

    def keep(metric: str) -> Column:
        if metric in SUSPENSION_PARTS or metric in totals:
            return F.col("parts_format")
        return ~F.col("parts_format") if metric == "out_of_school_suspension_count" else F.lit(True)

    def entries() -> list[Entry]:
        return [Entry(m, F.col(m), keep(m)) for m in measures() if m != "parts_format"]

    def defaults() -> list[Entry]:
        return [Entry(e.metric, F.lit(None).cast("double"), e.keep) for e in entries()]

    def flag() -> Column:
        inferred = C.infer_suppression(F.coalesce(*map(_n, [*SUSPENSION_PARTS.values(), "out_of_school_suspension"])), None)
        return F.when(F.exists("_source_header", lambda h: h.isin(COMMON_HEADERS["suppressed"])), C.suppression_flag("suppressed")).otherwise(inferred)

    return [_spec("out_of_school_suspension", measures, entries, defaults, flag, "metric")]


def _by_period(name: str, period: Callable[[], Column], measures: Callable[[], dict[str, Column]]) -> SourceSpec:
    """A spec whose metric names end in a grade or level of the row."""
    def named(stem: str) -> Column:
        return F.concat(F.lit(f"{stem}_"), F.col("period"))

    return _spec(name, lambda: {"period": period(), **measures()}, lambda: [Entry(named(m), F.col(m)) for m in measures()],
                 lambda: [Entry(named(m), F.lit(None).cast("double"), F.lit(True)) for m in measures()])


def _absenteeism() -> list[SourceSpec]:
    return [_by_period("chronic_absenteeism", lambda: L.normalize_grade("grade"), lambda: {
        "chronic_absenteeism_rate": C.range_guard(_n("chronic_absenteeism_rate"), 0, 100),
        "chronic_absenteeism_count": C.range_guard(_n("chronically_absent_count"), 0),
        "chronic_absenteeism_enrollment": C.range_guard(_n("enrollment_count"), 0)})]


def _english_learner() -> list[SourceSpec]:
    return [_by_period("english_learner_progress", lambda: L.normalize_level("level"), lambda: {
        f"english_learner_score_{k}": C.range_guard(_n(f"percentage_score_{k}"), 0, 100) for k in ("0", "60_80", "100", "140")})]


def _postsecondary_readiness() -> list[SourceSpec]:
    return [_spec("postsecondary_readiness", lambda: {
        "postsecondary_readiness_rate": C.range_guard(_n("postsecondary_rate"), 0, 100),
        "postsecondary_readiness_rate_with_bonus": C.range_guard(_n("postsecondary_rate_with_bonus"), 0, 150)}, defaults=lambda: [], policy="always")]


def delivers(*spellings: str) -> Column:
    """Whether the row's file has one of the columns."""
    return F.exists("_source_header", lambda h: h.isin(*spellings))


def _kindergarten() -> list[SourceSpec]:
    """A row is in the count format if all three parts are numbers.  The total ready is
    a rate, with a rate's bounds, only in rows of the percent format."""
    parts = {"rwi": "ready_with_interventions_count", "rdy": "ready_count", "rwe": "ready_with_enrichments_count"}

    def measures() -> dict[str, Column]:
        own = {k: C.range_guard(_n(c), 0) for k, c in parts.items()}
        tested = own["rwi"] + own["rdy"] + own["rwe"]
        counts = tested.isNotNull()
        prior, total = C.slugify("prior_setting"), _n("total_ready_count")
        return {"count_format": counts, **own, "tested": tested, "prior_slug": prior,
                "percent_file": delivers(*KINDERGARTEN_HEADERS["total_percent_ready"], *KINDERGARTEN_HEADERS["number_tested"]),
                "prior_all": F.col("prior_setting").isNull() | (prior == "all_students"), "demo_all": F.lower(F.trim("demographic")) == "all students",
                "ready": F.when(counts, C.range_guard(total, 0)), "number_tested": C.range_guard(_n("number_tested"), 0),
                "pct": F.when(~counts, F.coalesce(C.range_guard(_n("total_percent_ready"), 0, 100), C.range_guard(total, 0, 100)))}

    def flag() -> Column:
        m = measures()
        return C.override_suppression(C.suppression_flag("suppressed"), [F.coalesce(m["pct"], m["tested"], m["ready"])])

    return [_spec("kindergarten_readiness", measures, kindergarten_entries, kindergarten_defaults, flag)]


def _assessment() -> list[SourceSpec]:
    """By grade and by level; a row without a level has its grade's."""
    rates = {"novice_rate": "novice", "apprentice_rate": "apprentice", "proficient_rate": "proficient", "distinguished_rate": "distinguished",
             "proficient_distinguished_rate": "proficient_distinguished"}

    def measures() -> dict[str, Column]:
        grade, level = L.normalize_grade("grade"), L.normalize_level("level", None)
        return {"subject_n": L.normalize_subject("subject"), "grade_n": grade,
                "level_n": F.when((level == "all") & (grade != "all_grades"), L.grade_to_level(grade)).otherwise(level),
                "content_index_file": delivers(*ASSESSMENT_HEADERS["content_index"]),
                **{k: C.range_guard(_n(c), 0, 100) for k, c in rates.items()}, "content_index_score": C.range_guard(_n("content_index"), 0)}
    return [_spec("kentucky_summative_assessment", measures, assessment_entries, lambda: assessment_defaults(F.col("content_index_file")))]


EXPORTS = {
    "kindergarten_readiness": Export(KINDERGARTEN_HEADERS, _kindergarten),
    "kentucky_summative_assessment": Export(ASSESSMENT_HEADERS, _assessment),
    "chronic_absenteeism": Export(ABSENTEEISM_HEADERS, _absenteeism),
    "english_learner_progress": Export(ENGLISH_LEARNER_HEADERS, _english_learner),
    "postsecondary_readiness": Export(POSTSECONDARY_READINESS_HEADERS, _postsecondary_readiness),
    "graduation_rates": Export(GRADUATION_HEADERS, _graduation),
    "postsecondary_enrollment": Export(POSTSECONDARY_ENROLLMENT_HEADERS, _postsecondary_enrollment),
    "cte_participation": Export(CTE_HEADERS, _cte),
    "student_enrollment": Export(ENROLLMENT_HEADERS, _enrollment),
    "safe_schools_discipline": Export(DISCIPLINE_HEADERS, _discipline),
    "out_of_school_suspension": Export(SUSPENSION_HEADERS, _suspension),
}


def export_job(spark: SparkSession, source: str, pattern: str, dims: DemographicDims, allow: list[str] | None = None,
               multi_line: bool = False, level: str = "file") -> DataFrame:
    """KPI rows of a source's CSV files.  Columns that no file of the delivery
    has are null; ``level``: where a file's name stands (see ``source_file_column``)."""
    export = EXPORTS[source]
    raw = IO.scan_raw_csv(spark, pattern, allow=allow, multi_line=multi_line)
    wide = rename_columns(raw, export.headers).withColumn(SOURCE_FILE, IO.source_file_column("_source_path", level))
    missing = [c for c in [*IDS, "suppressed", *export.headers] if c not in wide.columns]
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in missing})
    return reduce(lambda a, b: a.unionByName(b), [run_spec(spec, wide, dims) for spec in export.specs()])
