"""Each data-quality rule flags its planted violation; a restarted stream with
the same checkpoint adds nothing twice."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.q_stream import W_COLUMNS, write_drops
from kpiloom.session import scratch_path
from kpiloom.streaming import ingest as ST
from tests.conftest import SF001


@pytest.mark.parametrize("key,rule", [
    ("dq_value_range", "rate_out_of_range"),
    ("dq_suppressed_null", "suppressed_with_value"),
    ("dq_suppressed_null", "bad_flag"),
    ("dq_band_rules", "combined_not_sum_of_bands"),
])
def test_planted_rule_violations(spark, key, rule):
    df = E.queries()[key](spark, SF001)
    assert df.filter(F.col("rule") == rule).count() > 0


@pytest.mark.parametrize("key", ["dq_rate_consistency", "dq_component_sum", "dq_duplicate_keys",
                                 "dq_baseline_diff", "dq_source_coverage", "dq_tier_consistency"])
def test_planted_violations_found(spark, key):
    assert E.queries()[key](spark, SF001).count() > 0


def test_stream_restart_is_exactly_once(spark):
    src = write_drops(spark, SF001)
    out, ckpt = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ckpt")
    ST.stream_kpi_ingest(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    first = ST.read_kpi_output(spark, out).count()
    ST.stream_kpi_ingest(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    assert ST.read_kpi_output(spark, out).count() == first
    assert first == E.queries()["wide_to_long"](spark, SF001).count()


def test_csv_drops_with_drifting_headers_in_any_order(spark, tmp_path):
    """Each run is a micro-batch: headers unknown before, a broken file, a replay of the same drops."""
    from kpiloom.plans.q_normalize import W_SOURCE_HEADERS
    drops, out, listing, ckpt = (f"file://{tmp_path}/{x}" for x in ("drops", "out", "listing", "ckpt"))
    (tmp_path / "drops" / "sub").mkdir(parents=True)
    def drop(name, header, *rows):
        (tmp_path / "drops" / name).write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")

    def run():
        ST.csv_kpi_ingest(ST.read_csv_drops(spark, drops), W_SOURCE_HEADERS, W_COLUMNS, W_DIMS, out, listing, ckpt)
        return sorted((r["year"], r["school_id"], r["metric"], r["value"]) for r in ST.read_kpi_output(spark, out).collect())

    total = W_SOURCE_HEADERS["total_count"]
    drop("late.csv", f"{total[0]},Demographic,School Code,School Year", "7,All Students,12,20232024", "8,All Students,13,20232024")
    first = run()
    assert first == [("2024", "12", "total_count", 7.0), ("2024", "13", "total_count", 8.0)]
    drop("sub/early.csv", f"SCHOOL YEAR,SCHOOL CODE,DEMOGRAPHIC,Never Seen,{total[-1]}", "20192020,44,All Students,x,9")
    (tmp_path / "drops" / "cut.csv.gz").write_bytes(b"this is not gzip")
    second = run()
    assert second == sorted([*first, ("2020", "44", "total_count", 9.0)])
    assert run() == second
    files = sorted((r["path"].rsplit("/", 1)[1], r["status"], r["n_lines"]) for r in spark.read.parquet(listing).collect())
    assert files == [("cut.csv.gz", "unreadable", None), ("early.csv", "ok", 2), ("late.csv", "ok", 3)]


def test_progress_writes_only_changed_files(spark):
    src = write_drops(spark, SF001)
    out, ckpt = scratch_path(spark, "progress"), scratch_path(spark, "progress-ckpt")
    ST.stream_progress_counts(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    first = {r["source_file"]: r["n_rows"] for r in ST.read_progress(spark, out).collect()}
    extra = spark.read.parquet(src).filter("school_year like '%1995'")
    extra.write.mode("append").parquet(src)
    ST.stream_progress_counts(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, out, ckpt)
    second = {r["source_file"]: r["n_rows"] for r in ST.read_progress(spark, out).collect()}
    assert {k for k in second if second[k] != first[k]} == {"wide_1995.csv"} and second["wide_1995.csv"] == 2 * first["wide_1995.csv"]
    assert [r[0] for r in spark.read.parquet(f"{out}/epoch=1").select("source_file").collect()] == ["wide_1995.csv"]


def test_required_groups_and_unpaired_metrics(spark):
    from kpiloom.operators.quality import dq_band_rules, dq_paired_metrics
    kpi = spark.createDataFrame([("2024", "a"), ("2024", "a"), ("2024", "b"), ("2023", "a"), ("2023", "b")], "year string, metric string")
    assert [tuple(r) for r in dq_paired_metrics(kpi, [("a", "b")]).select("year", "metric", "n_rows").collect()] == [("2024", "a|b", 1)]
    rules = {r["rule"]: r["n_violations"] for r in E.queries()["dq_demographic_rules"](spark, SF001).collect()}
    assert "required_groups" in rules
    bands = spark.createDataFrame([(1, 10., 20., 30., 40., 70.), (2, 10., 20., 30., 42., 72.), (3, 10., 20., 30., 40., 71.), (4, None, 20., 30., 40., 70.)],
                                  "k int, n double, a double, p double, d double, c double")
    got = sorted((r["k"], r["rule"]) for r in dq_band_rules(bands, ["k"], [F.col(x) for x in "napd"], F.col("c")).collect())
    assert got == [(2, "bands_not_100"), (3, "combined_not_sum_of_bands")]


def test_replayed_quarantine_batch_adds_nothing(spark, monkeypatch):
    """The first run fails between the two writes of a micro-batch; the restart replays it."""
    src = write_drops(spark, SF001, quarantine=True)
    good, bad, ckpt = (scratch_path(spark, x) for x in ("replay-good", "replay-bad", "replay-ckpt"))
    real = ST.kpi_from_typed

    def fails(*_):
        raise RuntimeError("lost between the writes")

    monkeypatch.setattr(ST, "kpi_from_typed", fails)
    with pytest.raises(Exception, match="lost between"):
        ST.stream_quarantine(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, good, bad, ckpt)
    first = spark.read.parquet(bad).count()
    monkeypatch.setattr(ST, "kpi_from_typed", real)
    ST.stream_quarantine(ST.read_drops(spark, src, W_COLUMNS), W_DIMS, good, bad, ckpt)
    assert first > 0 and spark.read.parquet(bad).count() == first
    assert spark.read.parquet(good).count() > 0


def test_incident_rate_takes_whole_rows(spark):
    from kpiloom.operators.events import incident_rate
    from kpiloom.schema import KPI_VALUE_COLUMNS
    base = dict.fromkeys(KPI_VALUE_COLUMNS)
    base |= {"year": "2024", "district": "d", "school_id": "1", "school_name": "s", "suppressed": "N"}
    a = {**base, "metric": "safe_students_affected_total", "student_group": "All Students"}
    e = {**base, "metric": "safe_event_count_total", "student_group": "All Students - Total Events", "value": 8.0, "county_name": "Z", "nces_id": "n"}
    rows = [{**a, "value": 4.0, "county_name": "Y"}, {**a, "value": 2.0, "county_name": "X"}, {**a, "value": 0.0, "county_name": "W"}, e]
    df = spark.createDataFrame([tuple(r[c] for c in KPI_VALUE_COLUMNS) for r in rows], ", ".join(f"{c} {'double' if c == 'value' else 'string'}" for c in KPI_VALUE_COLUMNS))
    got = incident_rate(df).collect()
    assert [(r["value"], r["county_name"], r["nces_id"]) for r in got] == [(4.0, "X", "n")]


def test_pivot_shows_every_group(spark):
    from kpiloom.operators.dashboard import heatmap_pivot
    rows = [("m", "2024", "a", g, float(i), "N") for i, g in enumerate(["All Students", "Some New Group"])] + [("m", "2024", "b", "All Students", 3.0, "N"), ("m", "2024", "b", "Hidden", None, "Y")]
    kpi = spark.createDataFrame(rows, "metric string, year string, school_name string, student_group string, value double, suppressed string")
    got = heatmap_pivot(kpi, "m", ["All Students", "Absent"])
    assert got.columns[4:] == ["All Students", "Absent", "other_groups"]
    assert [tuple(r)[2:] for r in got.orderBy("school_rank").collect()] == [("b", 1, 3.0, None, {}), ("a", 2, 0.0, None, {"Some New Group": 1.0})]


def test_source_coverage_joins_files_not_rows(spark):
    """However many rows a file has, one row a file goes on to the join; a file without a name counts as one."""
    from kpiloom.operators.quality import dq_source_coverage
    inputs = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "source_file string")
    kpi = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "source_file string, n int")
    found = dq_source_coverage(inputs, kpi)
    assert sorted(r[0] or "" for r in found.collect()) == ["", "b"]
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")[1]
    assert joined.count("Aggregate [source_file") == 2
