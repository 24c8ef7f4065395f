"""Hooks of a source spec, and cells of heatmaps that later deliveries are added to."""

import os

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.longform import Entry
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.specs import SourceSpec, SpecError, run_spec
from kpiloom.schema import KPI_VALUE_COLUMNS
from kpiloom.sources import cells

WIDE = [("20232024", "D", "S One", "1", "All Students", "N", 10.0), ("20232024", "D", "S Two", "2", "Total Events", "N", 20.0),
        ("20232024", "D", "S Three", "3", None, "N", 30.0), ("20232024", None, "S Four", "4", "All Students", "N", None)]


def spec(**hooks):
    return SourceSpec("own", lambda w: w, entries=lambda: [Entry("m", F.col("v"))], **hooks)


def run(spark, s):
    wide = spark.createDataFrame(WIDE, "school_year string, district_name string, school_name string, school_code string, demographic string, suppressed string, v double")
    return run_spec(s, wide, W_DIMS)


def test_hooks_add_to_the_step_that_they_replace(spark):
    assert {r["school_id"] for r in run(spark, spec()).collect()} == {"1"}
    assert {r["school_id"] for r in run(spark, spec(skip=lambda default: F.col("v") > 25)).collect()} == {"1", "2"}
    assert run(spark, spec(skip=lambda default: default | F.lit(True))).count() == 0
    hidden = run(spark, spec(id_template=lambda df, template: template(df).withColumn("suppressed", F.lit("Y")))).collect()
    assert [(r["value"], r["suppressed"]) for r in hidden] == [(None, "Y")]
    twice = run(spark, spec(convert=lambda df, emit: emit(df).unionByName(emit(df).withColumn("metric", F.lit("again"))).withColumn("extra", F.lit(1))))
    assert twice.columns == KPI_VALUE_COLUMNS and {r["metric"] for r in twice.collect()} == {"m", "again"}


@pytest.mark.parametrize("hooks,said", [
    ({"skip": lambda default: F.lit("yes")}, "skip: string, not boolean"),
    ({"id_template": lambda df, template: template(df).drop("school_id")}, "id template: no column school_id"),
    ({"id_template": lambda df, template: template(df).withColumn("year", F.lit(2024))}, "year is int, not string"),
    ({"convert": lambda df, emit: emit(df).withColumn("value", F.col("value").cast("string")).drop("nces_id")}, "value is string, not double; no column nces_id"),
    ({"convert": lambda df, emit: emit(df).select("*", F.lit("2020").alias("year"))}, "more than one column year"),
])
def test_wrong_results_of_hooks_fail_before_anything_runs(spark, hooks, said):
    with pytest.raises(SpecError) as e:
        run(spark, spec(**hooks))
    assert all(part in str(e.value) for part in said.split("; "))


KPI = "metric string, year string, district string, school_name string, student_group string, value double, suppressed string"


def kpi(spark, year, shift=0.0, n=40):
    rows = [("m", year, None if i % 5 == 0 else f"D{i % 2}", f"S{i % 7}", f"G{i % 3}", i + shift, "N") for i in range(n)]
    rows += [("m", year, "D0", "S0", "G0", 1e6, "Y"), ("m", year, "D0", "S0", "G0", None, "N"), ("m", None, "D0", "S0", "G0", 5.0, "N"), (None, year, "D0", "S0", "G0", 5.0, "N")]
    return spark.createDataFrame(rows, KPI)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def told(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_adding_a_year_touches_its_cells_only_and_equals_a_full_build(spark, tmp_path):
    path, full = f"file://{tmp_path}/cells", f"file://{tmp_path}/full"
    cells.store_cells(kpi(spark, "2022").unionByName(kpi(spark, "2023", 3.0)), path, "a")
    before = files(tmp_path / "cells")
    cells.store_cells(kpi(spark, "2024", 7.0), path, "a")
    after = files(tmp_path / "cells")
    assert before.items() < after.items() and all("year=2024" in f for f in after.keys() - before.keys())
    cells.store_cells(kpi(spark, "2022").unionByName(kpi(spark, "2023", 3.0)).unionByName(kpi(spark, "2024", 7.0)), full, "a")
    got = told(cells.series(cells.stored_cells(spark, path)))
    assert got == told(cells.series(cells.stored_cells(spark, full)))
    state = [r for r in got if r[0] == "state" and r[4] == "G0"]
    assert [(r[5], r[6], r[7], r[8]) for r in state] == [("2022", 14, 19.5, None), ("2023", 14, 22.5, 3.0), ("2024", 14, 26.5, 4.0)]


def test_deliveries_merge_replace_themselves_and_can_be_dropped(spark, tmp_path):
    path = f"file://{tmp_path}/cells"
    cells.store_cells(kpi(spark, "2022"), path, "a")
    alone = told(cells.series(cells.stored_cells(spark, path)))
    for _ in range(2):
        cells.store_cells(kpi(spark, "2022", 10.0, n=80), path, "b/late")
    both = told(cells.series(cells.stored_cells(spark, path)))
    rows = kpi(spark, "2022").unionByName(kpi(spark, "2022", 10.0, n=80)).filter("suppressed = 'N' and value is not null and year is not null and metric is not null")
    want = {(r["student_group"]): (r["n"], r["v"]) for r in rows.groupBy("student_group").agg(F.count("value").alias("n"), F.bround(F.round(F.avg("value"), 9), 1).alias("v")).collect()}
    assert {r[4]: (r[6], r[7]) for r in both if r[0] == "state"} == want
    cells.drop_delivery(spark, path, "b/late")
    assert told(cells.series(spark.read.schema(cells.CELLS).parquet(path))) == alone
    assert cells.series(cells.stored_cells(spark, path).filter("false")).count() == 0
