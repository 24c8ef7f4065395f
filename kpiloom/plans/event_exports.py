"""School-safety events from their exports: measures by type, grade, location and
context, whose files deliver one group or several.

A file's header says which measures it delivers; each of them is emitted for
every row of the file (a missing or negative number as suppressed), the others
not at all.  Rows are routed by tier, and affected students and total events
give the incident rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.operators.columns import rename_columns
from kpiloom.operators.demographics import DemographicDims
from kpiloom.operators.events import incident_rate, tier_split
from kpiloom.operators.longform import null_marker_strings, with_kpi_ids
from kpiloom.schema import ID_PASSTHROUGH, select_kpi_columns
from kpiloom.sources import csv_io as IO

# Measure columns and their header spellings, newest and historical.
TYPE_HEADERS = {
    "total_events": ["Total", "TOTAL EVENTS BY TYPE"],
    "alcohol_events": ["Alcohol", "ALCOHOL"],
    "assault_1st_degree": ["Assault, 1st Degree", "ASSAULT 1ST DEGREE"],
    "drug_events": ["Drugs", "DRUGS"],
    "harassment_events": ["Harassment (Includes Bullying)", "HARRASSMENT (INCLUDES BULLYING)"],
    "other_assault_events": ["Other Assault or Violence", "OTHER ASSAULT OR VIOLENCE"],
    "other_state_events": ["Other Events Resulting in State Resolutions", "OTHER EVENTS W_STATE RESOLUTION"],
    "tobacco_events": ["Tobacco", "TOBACCO"],
    "weapon_events": ["Weapons", "WEAPONS"],
}
GRADE_HEADERS = {
    "all_grades": ["All Grades", "TOTAL STUDENT COUNT"],
    "preschool": ["Preschool", "PRESCHOOL COUNT"],
    "kindergarten": ["K", "KINDERGARTEN COUNT"],
    **{f"grade_{i}": [f"Grade {i}", f"GRADE{i} COUNT"] for i in [*range(1, 13), 14]},
}
LOCATION_HEADERS = {
    "classroom": ["Classroom", "LOCATION - CLASSROOM"],
    "bus": ["Bus", "LOCATION - BUS"],
    "hallway_stairwell": ["Hallway/Stairwell", "LOCATION - HALLWAY/STAIRWAY"],
    "cafeteria": ["Cafeteria", "LOCATION - CAFETERIA"],
    "restroom": ["Restroom", "LOCATION - RESTROOM"],
    "gymnasium": ["Gymnasium", "LOCATION - GYMNASIUM"],
    "playground": ["Playground", "LOCATION - PLAYGROUND"],
    "other_location": ["Other", "LOCATION - OTHER"],
    "campus_grounds": ["Campus Grounds", "LOCATION - CAMPUS GROUNDS"],
}
CONTEXT_HEADERS = {
    "school_sponsored_during": ["School Sponsored Event; During School Hours", "SCHOOL SPONSORED SCHOOL HOURS"],
    "school_sponsored_not_during": ["School Sponsored Event; Not During School Hours", "SCHOOL SPONSORED NOT SCHOOL HOURS"],
    "non_school_sponsored_during": ["Non School Sponsored Event; During School Hours", "NON-SCHOOL SPONSORED SCHOOL HOURS"],
    "non_school_sponsored_not_during": ["Non School Sponsored Event; Not During School Hours", "NON-SCHOOL SPONSORED NOT SCHOOL HOURS"],
}
EVENT_HEADERS = TYPE_HEADERS | GRADE_HEADERS | LOCATION_HEADERS | CONTEXT_HEADERS
# Metric stems, where they are not the measure's column.
METRIC_STEMS = {
    "total_events": "total", "alcohol_events": "alcohol", "assault_1st_degree": "assault_1st", "drug_events": "drugs", "harassment_events": "harassment",
    "other_assault_events": "assault_other", "other_state_events": "other_state", "tobacco_events": "tobacco", "weapon_events": "weapons",
    "hallway_stairwell": "hallway", "campus_grounds": "campus", "school_sponsored_not_during": "school_sponsored_after",
    "non_school_sponsored_not_during": "non_school_after",
}
FORMAT_LABELS = ("historical_event_details", "historical_events_by_grade", "kyrc24_events_by_grade", "kyrc24_events_by_location", "kyrc24_events_by_context",
                 "kyrc24_events_by_type")
UNKNOWN_FORMAT = "unknown_format"


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def delivered(header: str = "_source_header") -> Column:
    """The measures in a file's header, in either spelling; null for other columns."""
    names = _literal_map({h: m for m, spellings in EVENT_HEADERS.items() for h in spellings})
    return F.transform(header, lambda h: names[h])


def event_format(measures: str) -> Column:
    """The format label of a row's file, by the measures it delivers; the first that fits."""
    has = lambda m: F.coalesce(F.array_contains(measures, m), F.lit(False))
    total, alcohol = has("total_events"), has("alcohol_events")
    fits = [total & has("assault_1st_degree") & has("classroom"), has("all_grades") & has("preschool"), total & has("all_grades"),
            total & has("classroom") & has("bus") & ~alcohol, total & has("school_sponsored_during") & ~alcohol, total & alcohol]
    label = F.lit(UNKNOWN_FORMAT)
    for name, fit in reversed(list(zip(FORMAT_LABELS, fits))):
        label = F.when(fit, F.lit(name)).otherwise(label)
    return label


def events_from(raw: DataFrame, dims: DemographicDims) -> DataFrame:
    """KPI rows of scanned event files: tiers, then incident rates."""
    wide = null_marker_strings(rename_columns(raw, EVENT_HEADERS))
    ids = ["school_year", "district_name", "school_name", "demographic", *ID_PASSTHROUGH]
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in [*ids, *EVENT_HEADERS] if c not in wide.columns})
    tiers = tier_split(wide.select(*ids, *EVENT_HEADERS, delivered().alias("delivered")).withColumn("data_format", event_format("delivered")))
    tier_name = F.when(F.col("tier") == 1, F.lit("_students_affected")).when(F.col("tier") == 3, F.lit("_total_events")).otherwise(F.lit(""))
    kpi = with_kpi_ids(tiers, dims, flag=F.lit("N"), source_file=F.concat(F.lit("safe_schools_events_"), "data_format", tier_name))
    kpi = kpi.withColumns({"student_group": F.coalesce("tier_group", "student_group"),
                           "school_id": F.coalesce("school_id", C.clean_school_id("state_school_id"))}).filter("school_id is not null")
    # cells are unfolded as text, so a number is parsed by one expression, not one a measure
    kept = [c for c in kpi.columns if c not in EVENT_HEADERS]
    cells = kpi.unpivot(kept, list(EVENT_HEADERS), "measure", "cell").filter(F.expr("array_contains(delivered, measure)"))
    stem = _literal_map({m: METRIC_STEMS.get(m, m) for m in EVENT_HEADERS})[F.col("measure")]
    long = cells.withColumns({"metric": F.concat("metric_prefix", stem, "metric_suffix"), "value": C.range_guard(C.parse_number("cell"), 0)})
    long = select_kpi_columns(long.withColumn("suppressed", F.when(F.col("value").isNull(), F.lit("Y")).otherwise(F.lit("N"))))
    return long.unionByName(incident_rate(long))


def event_export_job(spark: SparkSession, pattern: str, dims: DemographicDims, allow: list[str] | None = None) -> DataFrame:
    """KPI rows of a folder of event files."""
    return events_from(IO.scan_raw_csv(spark, pattern, allow=allow), dims)
