"""Operators on small frames: mapping precedence, emission policies, dedupe,
distributed ranking against a window brute force."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.operators.climate import dedupe_latest
from kpiloom.operators.demographics import DemographicDims, map_demographic
from kpiloom.operators.longform import Entry, entries_column, explode_entries
from kpiloom.operators.ranking import position_within

DIMS = DemographicDims(
    standard=["All Students", "Female", "Male", "Non-Foster Care", "Non-Economically Disadvantaged"],
    general_map=[("Non Economically Disadvantaged", "Non-Economically Disadvantaged"), ("Non-Foster", "Non-Foster Care"),
                 ("MALE", "Male"), ("male", "Female")],
    year_map=[("2022", "Non-English Learner or monitored", "Non-English Learner or monitored")])


def test_mapping_precedence(spark):
    rows = [("Non Economically Disadvantaged", "2024"), ("Non-Foster", "2024"), ("MALE", "2024"), ("Male", "2024"),
            ("mAlE", "2024"), ("all students", "2024"), (None, "2024"), ("", "2024"), ("Some New Category", "2024"),
            ("Non-English Learner or monitored", "2022"), (" Female ", "2024")]
    df = spark.createDataFrame(rows, "demographic string, year string")
    got = [(r.student_group, r.mapping_type) for r in map_demographic(df, DIMS).collect()]
    assert got == [("Non-Economically Disadvantaged", "general"), ("Non-Foster Care", "general"), ("Male", "general"),
                   ("Male", "standard"), ("Male", "case_insensitive"), ("all students", "no_mapping"),
                   ("All Students", "default"), ("All Students", "default"), ("Some New Category", "no_mapping"),
                   ("Non-English Learner or monitored", "year_specific"), ("Female", "standard")]


def _emit(spark, rows, policy, defaults=None):
    df = spark.createDataFrame(rows, "id int, suppressed string, a double, b double")
    entries = [Entry("a", F.col("a")), Entry("b", F.col("b"))]
    arr = entries_column(entries, policy, "suppressed", defaults)
    out = explode_entries(df, arr, ["id"])
    return sorted((r.id, r.metric, r.value, r.suppressed) for r in out.collect())


def test_row_policy(spark):
    rows = [(1, "N", 1.0, None), (2, "Y", None, None), (3, "Y", 5.0, None)]
    d = [Entry(m, F.lit(None).cast("double"), F.lit(True)) for m in ["a", "b", "c"]]
    assert _emit(spark, rows, "row", d) == [
        (1, "a", 1.0, "N"), (2, "a", None, "Y"), (2, "b", None, "Y"), (2, "c", None, "Y"), (3, "a", None, "Y")]


def test_metric_policy(spark):
    rows = [(1, "N", -1.0, 2.0), (2, "Y", None, None)]
    assert _emit(spark, rows, "metric", [Entry("a", F.lit(None).cast("double"), F.lit(True))]) == [
        (1, "a", None, "Y"), (1, "b", 2.0, "N"), (2, "a", None, "Y")]


def test_always_policy(spark):
    rows = [(1, "N", 1.0, None), (2, "Y", 3.0, 4.0)]
    assert _emit(spark, rows, "always") == [
        (1, "a", 1.0, "N"), (1, "b", None, "N"), (2, "a", None, "Y"), (2, "b", None, "Y")]


def test_dedupe_latest_idempotent(spark):
    from kpiloom.schema import LOGICAL_KEY
    base = {c: "x" for c in LOGICAL_KEY}
    rows = [dict(base, source_file="b.csv", value=2.0, suppressed="N"),
            dict(base, source_file="a.csv", value=1.0, suppressed="N"),
            dict(base, metric="m2", source_file="c.csv", value=None, suppressed="Y")]
    df = spark.createDataFrame(rows)
    once = dedupe_latest(df)
    twice = dedupe_latest(once)
    got = sorted((r.metric, r.source_file) for r in once.collect())
    assert got == [("m2", "c.csv"), ("x", "a.csv")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_position_within_matches_window_under_skew(spark):
    # one group holds most rows; ties on the score are broken by name
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("grp"),
        (F.col("id") % 97).cast("double").alias("score"), F.col("id").cast("string").alias("name"))
    order = [F.col("score").desc(), F.col("name").asc()]
    fast = position_within(df, ["grp"], order, out="pos", num_partitions=6)
    slow = df.withColumn("pos", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    a = sorted(map(tuple, fast.select("grp", "name", "pos").collect()))
    b = sorted(map(tuple, slow.select("grp", "name", "pos").collect()))
    assert a == b


def test_position_within_without_exchange_reuse(spark):
    """The ranks must not depend on the planner reusing the range exchange."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, 6000).select(
            F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("grp"),
            (F.col("id") % 97).cast("double").alias("score"), F.col("id").cast("string").alias("name"))
        df = df.repartition(5).groupBy("grp", "name").agg(F.max("score").alias("score"))
        order = [F.col("score").desc(), F.col("name").asc()]
        fast = position_within(df, ["grp"], order, out="pos", num_partitions=6)
        slow = df.withColumn("pos", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
        assert sorted(map(tuple, fast.select("grp", "name", "pos").collect())) == \
            sorted(map(tuple, slow.select("grp", "name", "pos").collect()))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


@pytest.mark.parametrize("n", [1, 7, 4000, 10**6])
def test_sample_per_file_of_any_size(spark, n):
    """The rows of a sort by hash, without one: a hot file, a null file, equal keys."""
    import hashlib

    from kpiloom.operators.quality import sample_per_file
    rows = [(f"f{i % 3}" if i % 7 else None if i % 2 else "hot", i // 2) for i in range(9000)] + [("hot", i) for i in range(20_000, 26_000)]
    got = sample_per_file(spark.createDataFrame(rows, "source_file string, k long"), n, ["k"]).collect()
    want = []
    for file in {f for f, _ in rows}:
        own = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for f, k in rows if f == file)
        want += [(file, k) for _, k in own[:n]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_baseline_diff_descends_only_into_parts_that_differ(spark):
    from kpiloom.operators.quality import dq_baseline_diff, run_digests
    from kpiloom.schema import LOGICAL_KEY
    schema = ", ".join(f"{c} string" for c in LOGICAL_KEY) + ", value double, suppressed string"
    base = [("d", str(i), None, y, g, m, float(i), "N") for i in range(5) for y in ("2020", "2021", None) for g in ("a", None) for m in ("x", "y")]
    change = {(1, "2020", "x"): 9.0, (2, None, "y"): None}
    new = [(*r[:6], change.get((int(r[1]), r[3], r[5]), r[6]), r[7]) for r in base if r[:4] != ("d", "4", None, "2021")] + [("d", "7", None, "2022", "a", "x", 1.0, "N")]
    old_df, new_df = spark.createDataFrame(base, schema), spark.createDataFrame(new[::-1], schema)
    got = {(r["school_id"], r["year"], r["student_group"], r["metric"], r["status"], r["old_value"], r["new_value"]) for r in dq_baseline_diff(old_df, new_df).collect()}
    want = {(str(i), y, g, m, "changed", float(i), v) for (i, y, m), v in change.items() for g in ("a", None)}
    want |= {("4", "2021", g, m, "removed", 4.0, None) for g in ("a", None) for m in ("x", "y")} | {("7", "2022", "a", "x", "added", None, 1.0)}
    assert got == want
    assert dq_baseline_diff(old_df, old_df.repartition(7)).count() == 0
    part = ["year", "metric"]
    a, b = (sorted(map(str, run_digests(d, part, [*LOGICAL_KEY, "value", "suppressed"]).collect())) for d in (old_df, new_df))
    assert len(set(a) & set(b)) == len(a) - 4   # (2020, x), (null, y), (2021, x), (2021, y)
