"""Climate and safety from their exports: survey answers, policy answers, direct
index scores and combined indicators of accountability profiles.

A file's header says what it delivers.  Survey files give means of the question
indexes by school and group; no single question is a score.  All others give
index scores and the share of policies in place.  One row a key is kept, of the
file whose name sorts first (``dedupe_latest``).

Cases: a file without a demographic column is about all students; without a
school year its year is the first 20xx in its name, else the default year; of a
combined rate and a direct score in one row the combined rate counts.  Id columns
that a survey file lacks stay null; those that it delivers empty are filled
(``survey_index_mean``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.operators.climate import dedupe_latest, survey_index_mean
from kpiloom.operators.columns import COMMON_HEADERS, rename_columns
from kpiloom.operators.demographics import DemographicDims, map_demographic
from kpiloom.operators.longform import Entry, null_marker_strings, skip_aggregate_rows, wide_to_long, with_kpi_ids
from kpiloom.plans.exports import IDS, SOURCE_FILE, delivers
from kpiloom.schema import ID_PASSTHROUGH, select_kpi_columns
from kpiloom.sources import csv_io as IO
from kpiloom.sources.deliveries import Deliveries, UnreadableFiles, scan

# Canonical columns and their header spellings.
POLICY_HEADERS = {
    "visitors_sign_in": ["Are visitors to the building required to sign-in?", "Visitors required to sign-in"],
    "classroom_doors_lock": ["Do all classroom doors lock from the inside?", "All classroom doors lock from the inside."],
    "classroom_phones": ["Do all classrooms have access to a telephone accessing outside lines?", "All classrooms have access to telephone"],
    "annual_climate_survey": ["Does your school administer a school climate survey annually?", "School climate survey administered annually."],
    "student_survey_data": ["Does your school collect and use student survey data?", "Student survey data collected and used"],
    "resource_officer": ["Does your school have a full-time School Resource Officer?", "Full-time resource officer"],
    "mental_health_referrals": ["Does your school have a process in place to provide mental health referrals for students?", "Mental health referral process in place"],
    "discipline_code_distributed": ["Is the district discipline code distributed to parents?", "District discipline code distributed to parents"],
}
INDEX_HEADERS = {
    "climate_index": ["Climate Index", "CLIMATE INDEX"],
    "safety_index": ["Safety Index", "SAFETY INDEX"],
    "climate_safety_combined_rate": ["QUALITY OF SCHOOL CLIMATE AND SAFETY COMBINED INDICATOR RATE", "QUALITY OF SCHOOL CLIMATE AND SAFETY INDICATOR RATE"],
}
SURVEY_HEADERS = {
    "question_type": ["Question Type", "QUESTION TYPE"],
    "question_index": ["Question Index", "QUESTION INDEX"],
}
LEVEL_HEADERS = {"level": ["Level", "LEVEL"]}
CLIMATE_HEADERS = POLICY_HEADERS | INDEX_HEADERS | SURVEY_HEADERS | LEVEL_HEADERS
# columns that a survey mean is grouped by, where a survey file delivers them
SURVEY_IDS = ["school_name", *ID_PASSTHROUGH, "school_number", "level"]


def _year() -> Column:
    named = F.regexp_extract(SOURCE_FILE, r"(20\d{2})", 1)
    return F.coalesce(F.when(F.col("school_year").isNotNull(), C.year_from_school_year("school_year")), F.nullif(named, F.lit("")), F.lit(C.DEFAULT_YEAR))


def _is_survey() -> Column:
    return delivers(*SURVEY_HEADERS["question_type"]) & delivers(*SURVEY_HEADERS["question_index"])


def survey_columns(found: Deliveries) -> set[str]:
    """Canonical columns that a survey file of the delivery has; column names only reach the driver."""
    headers = found.table.filter("status = 'ok'").select(F.col("header").alias("_source_header")).filter(_is_survey())
    spelled = {r["name"] for r in headers.select(F.explode("_source_header").alias("name")).distinct().collect()}
    return {c for c, spellings in {**COMMON_HEADERS, **CLIMATE_HEADERS}.items() if spelled & set(spellings)}


def survey_means(wide: DataFrame, delivered: set[str], dims: DemographicDims) -> DataFrame:
    """KPI rows: the means of the survey rows of ``wide``."""
    rows = map_demographic(wide.filter(_is_survey()).withColumns({"year": _year(), "district": F.col("district_name"), "source_file": F.col(SOURCE_FILE)}), dims)
    groups = ["district", "year", "student_group", "source_file", *(c for c in dict.fromkeys(SURVEY_IDS) if c in delivered)]
    means = survey_index_mean(rows, groups)
    none = F.lit(None).cast("string")
    means = means.withColumns({c: none for c in ["school_name", *ID_PASSTHROUGH] if c not in means.columns})
    return select_kpi_columns(means.withColumns({"school_id": C.clean_school_id("school_code"), "school_name": C.standardize_school_name("school_name")}))


def scores_and_policies(wide: DataFrame, dims: DemographicDims) -> DataFrame:
    """KPI rows of the files without survey answers."""
    rate = lambda c: C.range_guard(C.parse_number(c), 0, 100)
    combined = rate("climate_safety_combined_rate")
    rows = wide.filter(~_is_survey()).select(
        *IDS, C.suppression_flag("suppressed").alias("suppressed"), _year().alias("file_year"),
        F.coalesce(combined, rate("climate_index")).alias("climate"), F.coalesce(combined, rate("safety_index")).alias("safety"),
        D.policy_compliance(list(POLICY_HEADERS)).alias("policy"),
        delivers(*(s for own in INDEX_HEADERS.values() for s in own)).alias("index_file"),
        delivers(*(s for own in POLICY_HEADERS.values() for s in own)).alias("policy_file"))
    rows = with_kpi_ids(skip_aggregate_rows(rows), dims, source_file=F.col(SOURCE_FILE), year=F.col("file_year"))
    none = F.lit(None).cast("double")
    return wide_to_long(rows, [Entry("climate_index_score", F.col("climate")), Entry("safety_index_score", F.col("safety")),
                               Entry("safety_policy_compliance_rate", F.col("policy"))], "row",
                        [Entry("climate_index_score", none, F.col("index_file")), Entry("safety_index_score", none, F.col("index_file")),
                         Entry("safety_policy_compliance_rate", none, F.col("policy_file"))])


def climate_export_job(spark: SparkSession, pattern: str, dims: DemographicDims, allow: list[str] | None = None, level: str = "file") -> DataFrame:
    """KPI rows of a folder of climate files; ``level``: where a file's name stands."""
    found = IO.inspect_csv(spark, pattern, allow)
    if found.unreadable:
        raise UnreadableFiles(f"files that could not be read: {', '.join(sorted(found.unreadable))}")
    wide = rename_columns(scan(found), CLIMATE_HEADERS).withColumn(SOURCE_FILE, IO.source_file_column("_source_path", level))
    needed = dict.fromkeys([*IDS, "suppressed", *SURVEY_IDS, *CLIMATE_HEADERS])
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in needed if c not in wide.columns})
    wide = null_marker_strings(wide, exclude=["_source_path", SOURCE_FILE, "_corrupt"])
    wide = wide.withColumn("demographic", F.when(delivers(*COMMON_HEADERS["demographic"]), F.col("demographic")).otherwise("All Students"))
    return dedupe_latest(survey_means(wide, survey_columns(found), dims).unionByName(scores_and_policies(wide, dims)))
