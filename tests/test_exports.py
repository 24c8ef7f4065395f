"""Source jobs over CSV files with the sources' own headers."""

from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.exports import export_job

IDS = "SCHOOL YEAR,SCHOOL CODE,SCHOOL NAME,DISTRICT NAME,DEMOGRAPHIC"
NEW_IDS = "School Year,School Code,School Name,District Name,Demographic"
ROW = "20232024,000123,S One,D One,All Students"


def rows(spark, tmp_path, source, files):
    d = tmp_path / "raw"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text, encoding="utf-8")
    out = {}
    for r in export_job(spark, source, f"file://{d}/*.csv", W_DIMS).collect():
        out.setdefault(r["source_file"], {})[r["metric"]] = (r["value"], r["suppressed"])
    return out


def test_graduation_families_have_their_own_flags(spark, tmp_path):
    got = rows(spark, tmp_path, "graduation_rates", {
        "old.csv": f"{IDS},SUPPRESSED 4 YEAR,4-YEAR GRADUATION RATE,NUMBER OF GRADS IN 4-YEAR COHORT,SUPPRESSED 5 YEAR,5-YEAR GRADUATION RATE\n{ROW},N,91.5,\"1,020\",Y,93\n",
        "new.csv": f"{NEW_IDS},Suppressed,4 Year Cohort Graduation Rate\n{ROW},No,88\n"})
    assert got["old.csv"] == {"graduation_rate_4_year": (91.5, "N"), "graduation_count_4_year": (1020.0, "N"), "graduation_rate_5_year": (None, "Y")}
    assert got["new.csv"] == {"graduation_rate_4_year": (88.0, "N")}


def test_postsecondary_enrollment_names(spark, tmp_path):
    got = rows(spark, tmp_path, "postsecondary_enrollment", {"a.csv":
        f"{NEW_IDS},Total In Group,Public College Enrolled In State,Private College Enrolled In State,College Enrolled In State,"
        f"Percentage Public College Enrolled In State,Percentage Private College Enrolled In State,Percentage College Enrolled In State\n{ROW},100,40,10,50,40,10,50\n"})
    assert got["a.csv"] == {f"postsecondary_enrollment_{k}": (v, "N") for k, v in {
        "total_in_cohort": 100.0, "public_ky_college_count": 40.0, "private_ky_college_count": 10.0, "total_ky_college_count": 50.0,
        "public_ky_college_rate": 40.0, "private_ky_college_rate": 10.0, "total_ky_college_rate": 50.0}.items()}


def test_cte_rate_or_count(spark, tmp_path):
    head = f"{NEW_IDS},CTE Participants in All Grades,Total Number of Student,Grade 12 CTE Eligible Completer,Grade 12 CTE Completers"
    got = rows(spark, tmp_path, "cte_participation", {"a.csv": f"{head}\n{ROW},55.5,,20,80\n", "b.csv": f"{head}\n{ROW},150,300,,120\n"})
    assert got["a.csv"] == {"cte_participation_rate": (55.5, "N"), "cte_eligible_completer_count_grade_12": (20.0, "N"), "cte_completion_rate_grade_12": (80.0, "N")}
    assert got["b.csv"] == {"cte_participation_rate": (50.0, "N"), "cte_completion_count_grade_12": (120.0, "N")}


def test_enrollment_grades_and_levels(spark, tmp_path):
    got = rows(spark, tmp_path, "student_enrollment", {
        "new.csv": f"{NEW_IDS},All Grades,Preschool,K,Grade 1,Grade 6,Grade 9,Grade 14\n{ROW},60,0,10,20,12,15,3\n",
        "old.csv": f"{IDS},TOTAL STUDENT COUNT,KINDERGARTEN COUNT,GRADE12 COUNT\n{ROW},\"1,000\",*,40\n"})
    assert {k.removeprefix("student_enrollment_"): v[0] for k, v in got["new.csv"].items()} == {
        "total": 60, "kindergarten": 10, "grade_1": 20, "grade_6": 12, "grade_9": 15, "grade_14": 3, "primary": 30, "middle": 12, "secondary": 15}
    assert {k.removeprefix("student_enrollment_"): v[0] for k, v in got["old.csv"].items()} == {"total": 1000, "grade_12": 40, "secondary": 40}


def test_discipline_positive_counts(spark, tmp_path):
    got = rows(spark, tmp_path, "safe_schools_discipline", {
        "new.csv": f"{NEW_IDS},Restraint (SSP7),Arrests,Out-Of-School Suspensions (SSP3)\n{ROW},0,2,\"1,234\"\n",
        "old.csv": f"{IDS},SECLUSION SSP8\n{ROW},5\n"})
    assert got == {"new.csv": {"arrest_count": (2.0, "N"), "out_of_school_suspension_count": (1234.0, "N")}, "old.csv": {"seclusion_count": (5.0, "N")}}


def test_suspension_formats(spark, tmp_path):
    got = rows(spark, tmp_path, "out_of_school_suspension", {
        "new.csv": f"{NEW_IDS},Single Out-of-School With Disabilities,Single Out-of-School Without Disabilities,Multiple Out-of-School With Disabilities,"
                   f"Multiple Out-of-School Without Disabilities,In-School With Disabilities\n{ROW},1,2,*,4,5\n",
        "old.csv": f"{NEW_IDS},Out of School Suspension SSP3,Restraint SSP7\n{ROW},7,1\n"})
    new, old = ({k: v for k, v in got[f].items() if v[1] == "N"} for f in ("new.csv", "old.csv"))
    assert {k: v[0] for k, v in new.items()} == {
        "out_of_school_suspension_single_with_disabilities_count": 1, "out_of_school_suspension_single_without_disabilities_count": 2,
        "out_of_school_suspension_multiple_without_disabilities_count": 4, "out_of_school_suspension_single_total_count": 3,
        "out_of_school_suspension_multiple_total_count": 4, "out_of_school_suspension_total_count": 7,
        "in_school_suspension_with_disabilities_count": 5, "in_school_suspension_total_count": 5}
    assert got["new.csv"]["out_of_school_suspension_multiple_with_disabilities_count"] == (None, "Y") and "out_of_school_suspension_count" not in got["new.csv"]
    assert old["out_of_school_suspension_count"] == (7.0, "N") and old["restraint_count"] == (1.0, "N") and "out_of_school_suspension_total_count" not in got["old.csv"]


def test_absenteeism_names_by_grade(spark, tmp_path):
    got = rows(spark, tmp_path, "chronic_absenteeism", {
        "new.csv": f"{NEW_IDS},Grade,Chronically Absent Students,Students Enrolled 10 or More Days,Chronic Absenteeism Rate\n{ROW},All Grades,\"1,020\",4000,25.5\n",
        "old.csv": f"{IDS},GRADE,SUPPRESSED,CHRONIC ABSENTEE COUNT,PERCENT CHRONICALLY ABSENT\n{ROW},Grade 3,Yes,*,*\n"})
    assert got == {"new.csv": {"chronic_absenteeism_rate_all_grades": (25.5, "N"), "chronic_absenteeism_count_all_grades": (1020.0, "N"),
                               "chronic_absenteeism_enrollment_all_grades": (4000.0, "N")},
                   "old.csv": {f"chronic_absenteeism_{k}_grade_3": (None, "Y") for k in ("rate", "count", "enrollment")}}


def test_english_learner_names_by_level(spark, tmp_path):
    got = rows(spark, tmp_path, "english_learner_progress", {
        "new.csv": f"{NEW_IDS},Level,Percentage Of Value Table Score Of 0,Percentage Of Value Table Score Of 140\n{ROW},ES,10,101\n",
        "old.csv": f"{IDS},LEVEL,PERCENTAGE OF VALUE TABLE SCORE OF 60 AND 80\n{ROW},High School,7\n"})
    assert got == {"new.csv": {"english_learner_score_0_elementary": (10.0, "N")}, "old.csv": {"english_learner_score_60_80_high": (7.0, "N")}}


def test_readiness_gives_both_rates_always(spark, tmp_path):
    got = rows(spark, tmp_path, "postsecondary_readiness", {"a.csv": f"{NEW_IDS},Postsecondary Rate,Postsecondary Rate With Bonus\n{ROW},88,130\n",
                                                             "b.csv": f"{IDS},POSTSECONDARY RATE\n{ROW},*\n"})
    both = "postsecondary_readiness_rate", "postsecondary_readiness_rate_with_bonus"
    assert got == {"a.csv": dict(zip(both, [(88.0, "N"), (130.0, "N")])), "b.csv": dict(zip(both, [(None, "N"), (None, "N")]))}


def test_kindergarten_formats(spark, tmp_path):
    got = rows(spark, tmp_path, "kindergarten_readiness", {
        "counts.csv": f"{NEW_IDS},Suppressed,Prior Setting,Ready With Interventions,Ready,Ready With Enrichments,Total Ready\n{ROW},Yes,All Students,50,30,20,\"1,050\"\n",
        "hidden.csv": f"{NEW_IDS},Suppressed,Prior Setting,Ready With Interventions,Ready,Ready With Enrichments,Total Ready\n{ROW},Yes,Child Care,*,*,*,*\n",
        "percent.csv": f"{IDS},SUPPRESSED,PRIOR SETTING,TOTAL PERCENT READY,NUMBER TESTED\n{ROW},N,,45,50\n",
        "prior.csv": f"{IDS},SUPPRESSED,PRIOR SETTING,TOTAL PERCENT READY,NUMBER TESTED\n{ROW},Y,Head Start/State,*,*\n",
        "rate.csv": f"{NEW_IDS},Prior Setting,Total Ready,Number Tested\n{ROW},Child Care,60,10\n"})
    assert got["counts.csv"] == {f"kindergarten_{k}": (v, "N") for k, v in {
        "ready_with_interventions_count": 50, "ready_count": 30, "ready_with_enrichments_count": 20, "ready_with_interventions_rate": 50,
        "ready_rate": 30, "ready_with_enrichments_rate": 20, "readiness_count": 1050, "readiness_total": 100, "readiness_rate": 1050}.items()}
    assert len(got["hidden.csv"]) == 9 and set(got["hidden.csv"].values()) == {(None, "Y")} and "kindergarten_child_care_count" not in got["hidden.csv"]
    assert got["percent.csv"] == {"kindergarten_readiness_rate": (45, "N"), "kindergarten_readiness_total": (50, "N"), "kindergarten_readiness_count": (22, "N")}
    assert len(got["prior.csv"]) == 11 and got["prior.csv"]["kindergarten_head_start_state_rate"] == (None, "Y")
    assert got["rate.csv"] == {"kindergarten_child_care_rate": (60, "N"), "kindergarten_child_care_count": (6, "N")}


def test_assessment_by_grade_and_level(spark, tmp_path):
    got = rows(spark, tmp_path, "kentucky_summative_assessment", {
        "new.csv": f"{NEW_IDS},Grade,Subject,Suppressed,Novice,Proficient / Distinguished,Content Index\n{ROW},03,MA,No,12,101,130.5\n",
        "old.csv": f"{IDS},LEVEL,SUBJECT,SUPPRESSED,NOVICE,APPRENTICE\n{ROW},MS,Social Studies,N,7,9\n",
        "hidden.csv": f"{NEW_IDS},Level,Grade,Subject,Suppressed,Novice\n{ROW},High School,,RD,Yes,*\n"})
    own = {f: {k.removeprefix("kentucky_summative_assessment_"): v for k, v in r.items()} for f, r in got.items()}
    assert own["new.csv"] == {f"math_{n}_{p}": (v, "N") for p in ("grade_3", "elementary") for n, v in (("novice_rate", 12), ("content_index_score", 130.5))}
    assert own["old.csv"] == {"social_studies_novice_rate_middle": (7, "N"), "social_studies_apprentice_rate_middle": (9, "N")}
    assert own["hidden.csv"] == {f"reading_{n}_rate_high": (None, "Y") for n in ("novice", "apprentice", "proficient", "distinguished", "proficient_distinguished")}
