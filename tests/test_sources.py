"""CSV scan by header group: BOM, drifting headers, empty and header-only files."""

import gzip
import random

import pytest

from kpiloom.operators.columns import rename_columns
from kpiloom.sources import csv_io as IO


def test_scan_groups_by_header(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "new_2024.csv").write_text("﻿School Year,School Code,Demographic,Value\n20232024,000123,Female,1\n", encoding="utf-8")
    (d / "old_2020.csv").write_text("SCHOOL YEAR,SCHOOL CODE,DEMOGRAPHIC,EXTRA\n20192020,000456,MALE,x\n", encoding="utf-8")
    (d / "empty.csv").write_text("", encoding="utf-8")
    (d / "header_only.csv").write_text("School Year,School Code\n", encoding="utf-8")
    found = IO.inspect_csv(spark, f"file://{d}/*.csv")
    assert sorted((r["path"].rsplit("/", 1)[1], r["status"], r["n_lines"]) for r in found.table.collect()) == [
        ("empty.csv", "empty", None), ("header_only.csv", "ok", 1), ("new_2024.csv", "ok", 2), ("old_2020.csv", "ok", 2)]
    raw = IO.scan_raw_csv(spark, f"file://{d}/*.csv", deliveries=found)
    canon = rename_columns(raw)
    rows = sorted((r.school_year, r.school_code, r.demographic) for r in canon.collect())
    assert rows == [("20192020", "000456", "MALE"), ("20232024", "000123", "Female")]
    names = sorted(r[0] for r in canon.select(IO.source_file_column("_source_path")).collect())
    assert names == ["new_2024.csv", "old_2020.csv"]
    assert {"Value", "EXTRA"} <= set(canon.columns)


def test_allowlist_and_classify(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for n in ["acct_index_scores_2024.csv", "precautionary_measures_2023.csv", "notes.csv"]:
        (d / n).write_text("A\n1\n", encoding="utf-8")
    raw = IO.scan_raw_csv(spark, f"file://{d}/*.csv", allow=["*index_scores*", "precautionary_measures_*"])
    got = sorted((r.f, r.t) for r in raw.select(IO.source_file_column("_source_path").alias("f"),
                                                 IO.classify_file(IO.source_file_column("_source_path")).alias("t")).collect())
    assert got == [("acct_index_scores_2024.csv", "index_scores"), ("precautionary_measures_2023.csv", "precautionary_measures")]


def test_repeated_headers_line_breaks_and_bad_files(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "twice.csv").write_text("Name,Total,total\nx,1,2\ny,3\n", encoding="utf-8")
    (d / "broken.csv.gz").write_bytes(b"this is not gzip")
    found = IO.inspect_csv(spark, f"file://{d}/*")
    assert [p.rsplit("/", 1)[1] for p in found.unreadable] == ["broken.csv.gz"]
    raw = IO.scan_raw_csv(spark, f"file://{d}/*", deliveries=found)
    got = sorted((r["Name"], r["Total"], r["total_2"], r["_corrupt"]) for r in raw.select("Name", "Total", "total_2", "_corrupt").collect())
    assert got == [("x", "1", "2", None), ("y", "3", None, "y,3")]
    (d / "lines.csv").write_text('Name,Note\na,"one\ntwo"\nb,three\n', encoding="utf-8")
    whole = IO.scan_raw_csv(spark, f"file://{d}/lines.csv", multi_line=True)
    assert sorted((r["Name"], r["Note"]) for r in whole.collect()) == [("a", "one\ntwo"), ("b", "three")]


def test_no_file_counts_by_a_part_of_its_rows(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "good.csv").write_text("A,B\n1,2\n", encoding="utf-8")
    rnd = random.Random(1)
    whole = gzip.compress(("A,B\n" + "".join(f"{rnd.random()},{i}\n" for i in range(60_000))).encode())
    (d / "cut.csv.gz").write_bytes(whole[:len(whole) * 2 // 3])
    found = IO.inspect_csv(spark, f"file://{d}/*")
    assert sorted((r["path"].rsplit("/", 1)[1], r["status"]) for r in found.table.collect()) == [("cut.csv.gz", "unreadable"), ("good.csv", "ok")]
    assert all(r["error"] for r in found.table.filter("status = 'unreadable'").collect())
    assert [tuple(r) for r in IO.scan_raw_csv(spark, f"file://{d}/*", deliveries=found).select("A", "B").collect()] == [("1", "2")]
    with pytest.raises(IO.UnreadableFiles, match="cut.csv.gz"):   # nobody would hear of it
        IO.scan_raw_csv(spark, f"file://{d}/*")


def test_a_thousand_headers_are_one_scan(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for i in range(1000):
        names = [f"c{(i + k) % 40}" for k in range(3 + i % 5)] + [f"own {i}"] * (i % 50 == 0)
        (d / f"f {i}.csv").write_text(",".join(names) + "\n" + ",".join(f"{i}.{n}" for n in names) + "\n", encoding="utf-8")
    raw = IO.scan_raw_csv(spark, f"file://{d}/*.csv")
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [_0") == 1 and "Union" not in plan
    rows = raw.collect()
    assert len(rows) == 1000 and len(raw.columns) == 40 + 20 + 3
    for r in rows:
        i = int(r["_source_path"].rsplit("f%20", 1)[1].split(".")[0])
        assert all(r[n] == (f"{i}.{n}" if n in r["_source_header"] else None) for n in raw.columns[:-3]) and r["_corrupt"] is None


def test_rows_too_long_or_too_short_keep_their_line(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.csv").write_text('A,B\n1,2\n3\n4,5,6\n"x, y","say ""hi"""\n' + ",".join(map(str, range(40))) + "\n", encoding="utf-8")
    (d / "b.csv").write_text("A,B,C,D\n1,2,3,4\n", encoding="utf-8")
    got = sorted((r["A"], r["B"], r["_corrupt"]) for r in IO.scan_raw_csv(spark, f"file://{d}/*.csv").collect())
    assert got == [("0", "1", ",".join(map(str, range(40)))), ("1", "2", None), ("1", "2", None), ("3", None, "3"), ("4", "5", "4,5,6"), ("x, y", 'say "hi"', None)]


def test_two_sources_with_a_default_session(spark, tmp_path):
    """Neither sink depends on the session's overwrite mode (Spark's default is static)."""
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    kpi = spark.range(3).selectExpr("'2024' as year", "concat('m', id) as metric", "'d' as district", "cast(id as double) as value", "'N' as suppressed")
    for source in ("a", "b", "a"):
        IO.sink_kpi(kpi, f"file://{tmp_path}/kpi", source)
    assert sorted((r[0], r[1]) for r in IO.read_kpi(spark, f"file://{tmp_path}/kpi").groupBy("source").count().collect()) == [("a", 3), ("b", 3)]
    cells = kpi.selectExpr("metric", "year", "'s' as school_name", "1L as school_rank", "'g' as student_group", "value")
    stats = kpi.selectExpr("metric", "1L as total_schools")
    for source in ("a", "b", "a"):
        IO.sink_heatmap_json(cells, stats, f"file://{tmp_path}/json", source)
    assert sorted((r[0], r[1]) for r in IO.read_heatmap_json(spark, f"file://{tmp_path}/json").groupBy("source").count().collect()) == [("a", 6), ("b", 6)]


def test_scratch_of_other_applications_stays(spark):
    from kpiloom.session import checkpoint_root, clear_scratch, scratch_path
    other = f"{checkpoint_root(spark)}/kpiloom/app-of-another/x"
    own = scratch_path(spark, "x")
    for path in (other, own):
        spark.range(1).write.parquet(path)
    clear_scratch(spark)
    assert spark.read.parquet(other).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(own)


def test_format_comes_from_the_header_not_from_the_cells(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.csv").write_text("A,B\n1,\n,2\n", encoding="utf-8")
    (d / "b.csv").write_text("C\n1\n", encoding="utf-8")
    (d / "c.csv").write_text("D\n1\n", encoding="utf-8")
    raw = IO.scan_raw_csv(spark, f"file://{d}/*.csv")
    got = sorted(r[0] for r in IO.detect_format(raw, [("new", ["A", "B"]), ("old", ["C"])]).select("data_format").collect())
    assert got == ["new", "new", "old", "unknown_format"]


def test_kpi_sink_has_all_columns_and_splits_a_large_year(spark, tmp_path):
    from kpiloom.schema import KPI_COLUMNS
    kpi = spark.range(40_000).selectExpr("'2024' as year", "concat('m', id) as metric", "md5(cast(id as string)) as district", "cast(id as double) as value", "'N' as suppressed")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        IO.sink_kpi(kpi, f"file://{tmp_path}/kpi", "s")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "kpi" / "source=s" / "year=2024").glob("*.parquet"))) > 1
    back = spark.read.parquet(f"file://{tmp_path}/kpi")
    assert set(back.columns) == {*KPI_COLUMNS, "source"} and back.count() == 40_000
    assert back.filter("last_updated is null").count() == 0


def test_master_leaves_out_audit_and_short_tables(spark):
    from kpiloom.sources.master import REQUIRED_COLUMNS, union_master
    full = spark.createDataFrame([tuple("1" for _ in REQUIRED_COLUMNS)], ", ".join(f"{c} string" for c in REQUIRED_COLUMNS))
    got = union_master(spark, [("a", full), ("a_demographic_audit", full), ("short", full.select("year", "metric"))])
    assert [r["source"] for r in got.collect()] == ["a"]
    assert union_master(spark, []).count() == 0


def test_master_follows_the_stored_tables(spark, tmp_path):
    """Only changed partitions are replaced; the result equals a full build at every step."""
    from kpiloom.schema import KPI_VALUE_COLUMNS
    from kpiloom.sources.store import update_master
    kpi, master, manifest = (f"file://{tmp_path}/{x}" for x in ("kpi", "master", "manifest"))

    def rows(*years, by=1):
        return spark.createDataFrame([(y, f"m{i}", "d", str(i), "g", float(i * by), "N", "f") for y in years for i in range(3)],
                                     "year string, metric string, district string, school_id string, student_group string, value double, suppressed string, source_file string")

    def update():
        done = update_master(spark, kpi, master, manifest)
        same = lambda path: sorted(map(str, IO.read_kpi(spark, path).filter("source not like '%audit' and source <> 'short'").select(*KPI_VALUE_COLUMNS, "source").collect()))
        assert same(master) == same(kpi)
        return done

    IO.sink_kpi(rows("2020", "2021"), kpi, "a")
    IO.sink_kpi(rows("2021"), kpi, "b c/d")
    rows("2021").drop("suppressed").write.partitionBy("year").parquet(f"{kpi}/source=short")
    IO.sink_kpi(rows("2021"), kpi, "a_demographic_audit")
    first = update()
    assert first.replaced == [("a", "2020"), ("a", "2021"), ("b c/d", "2021")] and first.left_out == ["a_demographic_audit", "short"]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "master").rglob("*.parquet")}
    assert update().replaced == []
    IO.sink_kpi(rows("2022"), kpi, "a")                # one new year: one partition read and written
    assert update().replaced == [("a", "2022")]
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    IO.sink_kpi(rows("2021", by=5), kpi, "a")          # a corrected year
    assert update().replaced == [("a", "2021")]
    import shutil
    shutil.rmtree(tmp_path / "kpi" / "source=a" / "year=2020")
    gone = update()
    assert gone.removed == [("a", "2020")] and gone.replaced == []


def test_fields_of_a_row_are_put_together_once(spark, tmp_path):
    d = tmp_path / "spaced name"
    d.mkdir()
    (d / "a+b.csv").write_text("A,B,C\n1,2,3\n4,5\n")
    (d / "c.csv").write_text("B,A\n6,7\n8,9,10\n")
    raw = IO.scan_raw_csv(spark, f"file://{d}/*.csv")
    plan = raw.select("A", "B", "C")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array(_0") == 1 and "_3#" not in plan.split("array(_0")[1].split("Relation")[0]
    got = sorted((r["A"], r["B"], r["C"], r["_corrupt"]) for r in raw.collect())
    assert got == [("1", "2", "3", None), ("4", "5", None, "4,5"), ("7", "6", None, None), ("9", "8", None, "8,9,10")]
