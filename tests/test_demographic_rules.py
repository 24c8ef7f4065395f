"""The state's labels from a stored table of rules: cases by year, versions, equality with the mapping by lists."""

import pytest

from kpiloom.operators.demographic_rules import map_by_rules, read_rules, rule_rows, write_rules
from kpiloom.operators.demographics import demographic_coverage, map_demographic
from kpiloom.plans import state_labels as L
from kpiloom.plans.q_demo import SPELLINGS


@pytest.fixture(scope="module")
def rules(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('rules')}/rules"
    assert write_rules(spark, rule_rows(["All Students"], [], []), path) == 1
    assert write_rules(spark, rule_rows(L.STANDARD, L.GENERAL, L.BY_YEAR), path) == 2
    assert read_rules(spark, path, up_to=1).count() == 1
    with pytest.raises(FileNotFoundError):
        read_rules(spark, path, up_to=0)
    return read_rules(spark, path)


def test_cases(spark, rules):
    cases = [("Non Economically Disadvantaged", "2024", "Non-Economically Disadvantaged", "year_specific"),
             ("Non Economically Disadvantaged", "2021", "Non-Economically Disadvantaged", "general"),
             ("Non English Learner", "2024", "Non-English Learner", "year_specific"), ("Non-Foster", "2024", "Non-Foster Care", "year_specific"),
             ("Student without Disabilities (IEP)", "2024", "Students without IEP", "year_specific"), ("All Students", "2024", "All Students", "standard"),
             ("Female", "2024", "Female", "standard"), ("all students", "2024", "All Students", "general"), ("MALE", "2024", "Male", "case_insensitive"),
             ("Non-English Learner or monitored", "2022", "Non-English Learner or monitored", "standard"),
             ("English Learner including Monitored", "2021", "English Learner including Monitored", "standard"),
             ("Non Gifted and Talented", "2023", "Non-Gifted and Talented", "year_specific"), ("Non Gifted and Talented", None, "Non-Gifted and Talented", "general"),
             (None, "2024", "All Students", "default"), ("", "2024", "All Students", "default"), (" Female ", "x", "Female", "standard"),
             ("Some New Category", "2024", "Some New Category", "no_mapping")]
    got = map_by_rules(spark.createDataFrame([c[:2] for c in cases], "demographic string, year string"), rules).collect()
    assert sorted(map(tuple, got), key=str) == sorted(cases, key=str)


def test_same_as_the_lists(spark, rules):
    df = spark.createDataFrame([(x, str(y)) for x in SPELLINGS for y in range(2019, 2026)], "demographic string, year string")
    assert sorted(map(tuple, map_by_rules(df, rules).collect())) == sorted(map(tuple, map_demographic(df, L.STATE_DIMS).collect()))


def test_a_later_rule_of_less_precedence_and_ranges(spark):
    from kpiloom.operators.demographic_rules import RULE_SCHEMA
    own = [("a", "X", "one", False, None, 2020, 2, 0), ("b", "X", "two", False, 2020, None, 1, 1), ("c", "x", "three", True, None, None, 3, 2)]
    df = spark.createDataFrame([("X", "2019"), ("X", "2020"), ("X", "2021"), ("x", "2021"), ("X", None)], "demographic string, year string")
    got = map_by_rules(df, spark.createDataFrame(own, RULE_SCHEMA)).collect()
    assert sorted((r["demographic"], r["year"] or "", r["student_group"]) for r in got) == [
        ("X", "", "three"), ("X", "2019", "one"), ("X", "2020", "two"), ("X", "2021", "two"), ("x", "2021", "three")]


def test_coverage_of_a_year(spark):
    seen = spark.createDataFrame([("2024", g) for g in ("All Students", "Female", "Asian", "English Learner", "Odd")], "year string, student_group string")
    by = {}
    for r in demographic_coverage(seen, L.STATE_DIMS).collect():
        by.setdefault(r["status"], set()).add(r["student_group"])
    assert by["valid"] == {"All Students", "Female", "Asian", "English Learner"} and by["unexpected"] == {"Odd"}
    assert by["missing_required"] == set(L.REQUIRED) - {"All Students", "Asian"}
