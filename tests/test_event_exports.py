"""Event exports: every measure by type, grade, location and context."""

import pytest

from kpiloom.plans import event_exports as E
from kpiloom.plans.dims import W_DIMS

IDS = "School Year,School Code,School Name,District Name,Demographic"
OLD_IDS = "SCHOOL YEAR,SCHOOL CODE,SCHOOL NAME,DISTRICT NAME,DEMOGRAPHIC"


def scanned(spark, tmp_path, files):
    d = tmp_path / "raw"
    d.mkdir()
    for name, (head, lines) in files.items():
        body = "\n".join(f"20232024,000123,S One,D One,{line}" for line in lines)
        (d / name).write_text(f"{head}\n{body}\n", encoding="utf-8")
    return E.IO.scan_raw_csv(spark, f"file://{d}/*.csv")


def quoted(headers, spelling):
    return ",".join(f'"{h[spelling]}"' for h in headers.values())


def test_every_measure_in_both_spellings(spark, tmp_path):
    n = len(E.EVENT_HEADERS)
    cells = ",".join(str(i + 1) for i in range(n))
    raw = scanned(spark, tmp_path, {"new.csv": (f"{IDS},{quoted(E.EVENT_HEADERS, 0)}", [f"All Students,{cells}"]),
                                    "old.csv": (f"{OLD_IDS},{quoted(E.EVENT_HEADERS, 1)}", [f"Total Events,{cells}"])})
    got = {}
    for r in E.events_from(raw, W_DIMS).collect():
        got.setdefault((r["source_file"], r["student_group"]), {})[r["metric"]] = r["value"]
    stems = ["total", "alcohol", "assault_1st", "drugs", "harassment", "assault_other", "other_state", "tobacco", "weapons", "all_grades", "preschool",
             "kindergarten", *(f"grade_{i}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14)), "classroom", "bus", "hallway", "cafeteria", "restroom", "gymnasium",
             "playground", "other_location", "campus", "school_sponsored_during", "school_sponsored_after", "non_school_sponsored_during", "non_school_after"]
    assert len(stems) == n
    assert got.pop(("safe_schools_events_historical_event_details_students_affected", "All Students")) == {f"safe_students_affected_{s}": i + 1 for i, s in enumerate(stems)}
    assert got.pop(("safe_schools_events_historical_event_details_total_events", "All Students - Total Events")) == {
        f"safe_event_count_{s}": i + 1 for i, s in enumerate(stems)}
    assert {k: v for own in got.values() for k, v in own.items()} == {f"safe_incident_rate_{s}": 1.0 for s in stems}


def test_only_delivered_measures_and_suppressed_cells(spark, tmp_path):
    raw = scanned(spark, tmp_path, {"a.csv": (f"{IDS},Total,Classroom,Bus,Other", ["Female,*,3,-1,\"1,020\""]), "b.csv": (f"{IDS},Total,Alcohol", ["All Students,0,"])})
    got = {(r["metric"], r["student_group"]): (r["value"], r["suppressed"]) for r in E.events_from(raw, W_DIMS).collect()}
    assert {k: v for k, v in got.items() if k[0].endswith("_by_demo")} == {
        (f"safe_event_count_{m}_by_demo", "Female"): v for m, v in {"total": (None, "Y"), "classroom": (3.0, "N"), "bus": (None, "Y"), "other_location": (1020.0, "N")}.items()}
    assert {k[0]: v for k, v in got.items() if k[1] == "All Students"} == {"safe_students_affected_total": (0.0, "N"), "safe_students_affected_alcohol": (None, "Y")}


@pytest.mark.parametrize("columns, label", [
    ("TOTAL EVENTS BY TYPE,ASSAULT 1ST DEGREE,LOCATION - CLASSROOM", "historical_event_details"),
    ("TOTAL STUDENT COUNT,PRESCHOOL COUNT", "historical_events_by_grade"),
    ("Total,All Grades,Preschool", "historical_events_by_grade"),
    ("Total,All Grades,Grade 1", "kyrc24_events_by_grade"),
    ("Total,Classroom,Bus", "kyrc24_events_by_location"),
    ("Total,School Sponsored Event; During School Hours", "kyrc24_events_by_context"),
    ("Total,Alcohol,Classroom,Bus", "kyrc24_events_by_type"),
    ("Total", "unknown_format"),
    ("Classroom,Bus", "unknown_format"),
])
def test_format_labels(spark, columns, label):
    header = spark.createDataFrame([([*IDS.split(","), *columns.split(",")],)], "_source_header array<string>")
    assert header.select(E.delivered().alias("d")).select(E.event_format("d")).first()[0] == label
