"""Column functions on literal cases (school year, ids, numbers, flags, labels)."""

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.functions import labels as L


def one(spark, expr, rows, schema="x string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("out")).collect()]


def test_year_from_school_year(spark):
    assert one(spark, C.year_from_school_year("x"), [("20232024",), ("2023",), ("bad",), (None,)]) == \
        ["2024", "2023", "2024", "2024"]


def test_clean_school_id(spark):
    assert one(spark, C.clean_school_id("x"), [("010203",), (" 010203.0 ",), ("",), (None,)]) == \
        ["010203", "010203", None, None]


def test_school_name(spark):
    assert one(spark, C.standardize_school_name("x"), [(None,), ("All Schools",), (" A ",)]) == \
        ["Unknown School", "---District Total---", "A"]


def test_parse_number_is_strict(spark):
    got = one(spark, C.parse_number("x"), [("1,234",), ("12.5%",), ("*",), ("12d",), ("1_000",), (" 12 ",),
                                           ("1e3",), ("inf",), ("NaN",), ('"7"',)])
    assert got == [1234.0, 12.5, None, None, None, 12.0, 1000.0, None, None, 7.0]


def test_null_markers(spark):
    got = one(spark, C.null_markers("x"), [("*",), ("---",), ("<10",), ("N/A",), ("NaN",), ("ok",), ("",)])
    assert got == [None, None, None, None, None, "ok", None]


def test_range_guard(spark):
    assert one(spark, C.range_guard(F.col("x"), 0, 100), [(-1.0,), (0.0,), (100.0,), (100.5,)], "x double") == \
        [None, 0.0, 100.0, None]


def test_suppression_flag(spark):
    got = one(spark, C.suppression_flag("x"), [("Yes",), ("y",), ("1",), ("TRUE",), ("No",), ("0",), ("maybe",), (None,)])
    assert got == ["Y", "Y", "Y", "Y", "N", "N", "N", "N"]


def test_slugify(spark):
    assert one(spark, C.slugify("x"), [("Child Care",), ("Head-Start / Home",), (None,)]) == \
        ["child_care", "head_start__home", "unknown"]


def test_grade_level_subject(spark):
    rows = [("03",), ("Grade 7",), ("All Grades",), ("Pre-K",), (None,), ("11",)]
    grades = one(spark, L.normalize_grade("x"), rows)
    assert grades == ["grade_3", "grade_7", "all_grades", "pre_k", "all_grades", "grade_11"]
    levels = one(spark, L.grade_to_level(L.normalize_grade("x")), rows)
    assert levels == ["elementary", "middle", "all", "elementary", "all", "high"]
    assert one(spark, L.normalize_subject("x"), [("MA",), ("Social Studies",), ("Art",), ("",)]) == \
        ["math", "social_studies", "art", "unknown_subject"]
    assert one(spark, L.normalize_level("x"), [("ES",), ("High School",), ("Other",), (None,)]) == \
        ["elementary", "high", "all", "all"]


def test_policy_compliance(spark):
    cols = [f"p{i}" for i in range(8)]
    rows = [tuple(["Yes"] * 8), tuple(["Yes"] * 6 + ["No"] * 2), tuple([" yes "] * 6 + ["No", "No"]),
            tuple(["YES"] * 7 + ["No"]), tuple([None] * 8)]
    got = one(spark, D.policy_compliance(cols), rows, ", ".join(f"{c} string" for c in cols))
    assert got == [100.0, 75.0, 75.0, 87.5, None]


def test_rounding_half_even(spark):
    assert one(spark, D.count_from_rate(F.col("r"), F.col("t")), [(12.5, 100.0), (13.5, 100.0)], "r double, t double") == \
        [12.0, 14.0]


def test_rate_or_count(spark):
    df = spark.createDataFrame([(50.0, 10.0), (150.0, 300.0), (150.0, None)], "v double, t double")
    rate, count = D.rate_or_count("v", "t")
    got = [tuple(r) for r in df.select(rate, count).collect()]
    assert got == [(50.0, None), (50.0, None), (None, 150.0)]


def test_horizontal_sums(spark):
    df = spark.createDataFrame([(1.0, None, 0.0), (None, None, None), (-1.0, 2.0, 3.0)], "a double, b double, c double")
    got = [tuple(r) for r in df.select(D.sum_null_as_zero(["a", "b", "c"]), D.sum_positive_or_null(["a", "b", "c"])).collect()]
    assert got == [(1.0, 1.0), (0.0, None), (4.0, 5.0)]


def test_survey_mean_takes_negative_scores_and_ignores_order(spark):
    from kpiloom.operators.climate import survey_index_mean
    rows = [("g", "C", x) for x in ["52.6", "52.7", "52.6", "52.7"]] + [("h", "climate", "0.25"), ("h", "C", "0.35"), ("n", "C", "-4"), ("n", "C", "6"), ("n", "C", "*")]
    df = spark.createDataFrame(rows, "district string, question_type string, question_index string")
    out = {r.district: (r.value, r.question_count) for r in survey_index_mean(df, ["district"]).collect()}
    assert out == {"g": (52.6, 4), "h": (0.3, 2), "n": (1.0, 2)}


def test_snake_case():
    from kpiloom.functions.clean import to_snake_case
    assert [to_snake_case(x) for x in ["School Year", "stateSchoolId", "Alpha Events (A)", "Return-Events", "NCESId", "a1B", " X  Y "]] == [
        "school_year", "state_school_id", "alpha_events_a", "return_events", "nces_id", "a1_b", "x_y"]


def test_zero_divisors_are_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 0.0, 3.0)], "a double, b double, c double")
    got = [r[0] for r in df.select(D.share_of_sum("a", ["a", "b", "c"])).collect()]
    assert got == [None, 25.0]
    from kpiloom.plans.q_jobs import _kg_entries  # entry values divide by the tested count
    kg = spark.createDataFrame([(True, True, False, "child_care", 0.0, 0.0, 0.0, 0.0, 0.0, None, None)],
                               "count_format boolean, prior_all boolean, demo_all boolean, prior_slug string, rwi double, "
                               "rdy double, rwe double, tested double, ready double, pct double, number_tested double")
    vals = kg.select(*[e.value.alias(f"v{i}") for i, e in enumerate(_kg_entries())]).collect()[0]
    assert vals is not None
