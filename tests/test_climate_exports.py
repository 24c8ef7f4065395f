"""Climate files with the source's headers: surveys, policies, direct and combined scores."""

from kpiloom.plans.climate_exports import climate_export_job
from kpiloom.plans.dims import W_DIMS

IDS = "School Year,School Code,School Name,District Name,Demographic"
OLD_IDS = "SCHOOL YEAR,SCHOOL CODE,SCHOOL NAME,DISTRICT NAME,DEMOGRAPHIC"
ROW = "20232024,000123,S One,D One,All Students"


def rows(spark, tmp_path, files):
    d = tmp_path / "raw"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text, encoding="utf-8")
    return climate_export_job(spark, f"file://{d}/*.csv", W_DIMS).collect()


def brief(got):
    return {(r["source_file"], r["year"], r["metric"]): (r["value"], r["suppressed"]) for r in got}


def test_scores_policies_and_survey_means(spark, tmp_path):
    got = rows(spark, tmp_path, {
        "a_index.csv": f"{IDS},Suppressed,Climate Index,Safety Index\n{ROW},No,71.5,101\n",
        "b_profile.csv": f"{OLD_IDS},QUALITY OF SCHOOL CLIMATE AND SAFETY COMBINED INDICATOR RATE\n20212022,000123,S One,D One,All Students,64.2\n",
        "precautionary_measures_2021.csv": "School Code,School Name,District Name,Visitors required to sign-in,Full-time resource officer,Student survey data collected and used\n"
                                           "000123,S One,D One,Yes,no,\n000124,S Two,D One,,,\n",
        "survey.csv": f"{IDS},CO-OP,Question Type,Question Index\n{ROW},,C,70\n{ROW},,climate ,81\n{ROW},,S,*\n{ROW},,Safety,-3\n{ROW},,X,5\n"})
    assert brief(got) == {
        ("a_index.csv", "2024", "climate_index_score"): (71.5, "N"),
        ("b_profile.csv", "2022", "climate_index_score"): (64.2, "N"), ("b_profile.csv", "2022", "safety_index_score"): (64.2, "N"),
        ("precautionary_measures_2021.csv", "2021", "safety_policy_compliance_rate"): (50.0, "N"),
        ("survey.csv", "2024", "climate_index_score_calculated"): (75.5, "N"), ("survey.csv", "2024", "safety_index_score_calculated"): (-3.0, "N")}
    mean = next(r for r in got if r["metric"] == "climate_index_score_calculated")
    assert mean["co_op"] == "999" and mean["county_number"] is None and mean["school_id"] == "000123" and mean["student_group"] == "All Students"


def test_suppressed_defaults_follow_the_header(spark, tmp_path):
    got = rows(spark, tmp_path, {
        "index.csv": f"{IDS},Suppressed,Climate Index\n{ROW},Yes,*\n",
        "policy.csv": f"{IDS},Suppressed,Visitors required to sign-in\n20222023,000123,S One,D One,All Students,Yes,\n"})
    assert brief(got) == {("index.csv", "2024", "climate_index_score"): (None, "Y"), ("index.csv", "2024", "safety_index_score"): (None, "Y"),
                          ("policy.csv", "2023", "safety_policy_compliance_rate"): (None, "Y")}


def test_one_row_a_key_and_no_file_at_all(spark, tmp_path):
    got = rows(spark, tmp_path, {f: f"{IDS},Climate Index\n{ROW},{v}\n" for f, v in (("b.csv", 10), ("a.csv", 20), ("c.csv", 30))})
    assert brief(got) == {("a.csv", "2024", "climate_index_score"): (20.0, "N")}
    assert climate_export_job(spark, f"file://{tmp_path}/none/*.csv", W_DIMS).count() == 0
