"""W, T and B over line items whose schools, customers and segments repeat or are
missing, against the fixtures' SQL; and what the queries over them read."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import quality as Q
from kpiloom.operators.longform import Entry, entries_column, explode_entries
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_jobs import JOB_SPECS
from kpiloom.plans.specs import run_spec
from kpiloom.session import WRITER_SETTINGS
from kpiloom.sources import fixtures
from kpiloom.sources.csv_io import read_kpi, sink_kpi
from kpiloom.sources.tables import Tables

ROWS = {
    "region": ("r_regionkey long, r_name string", [(0, "R0"), (1, "R1")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "N0", 0), (1, "N1", 1)]),
    # 50 stands twice at one place, 7 at two places, 8 nowhere
    "supplier": ("s_suppkey long, s_nationkey long", [(50, 0), (50, 0), (7, 0), (7, 1), (8, None), (9, 1), (None, 1)]),
    # customer 2 stands twice, customer 3 has no segment
    "customer": ("c_custkey long, c_mktsegment string", [(1, "AUTOMOBILE"), (2, "BUILDING"), (2, "BUILDING"), (3, None), (None, "MACHINERY")]),
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp",
               [(i, (1, 2, 3, None, 9)[i % 5], None if i == 11 else datetime.datetime(1996 + i % 3, 5, 6)) for i in range(40)] + [(1, 1, datetime.datetime(1997, 1, 1))]),
    "lineitem": ("l_orderkey long, l_suppkey long, l_returnflag string, l_linenumber int, l_quantity double",
                 [(i % 43, (50, 7, 8, 9, None, 99)[i % 6], ("A", "N", "R", None)[i % 4], None if i % 29 == 0 else i % 7, None if i % 31 == 0 else float(i % 50 + 1))
                  for i in range(900)]),
}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("odd"))
    for name, (schema, rows) in ROWS.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def _rows(found):
    return sorted((tuple(map(str, r)) for r in found))


@pytest.mark.parametrize("name, fixture", [("fx_w", fixtures.wide), ("fx_wp", fixtures.wide_parts), ("fx_t", fixtures.tiers), ("fx_b", fixtures.bands)])
def test_groups_of_repeated_and_missing_keys(spark, odd, name, fixture):
    got = fixture(Tables(spark, odd))
    con = duckdb.connect()
    for table in ROWS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{odd}/{table}.parquet/*.parquet')")
    want = con.execute(ctes(name) + f"SELECT {', '.join(got.columns)} FROM {name}").fetchall()
    assert want and _rows(got.collect()) == _rows(want)


def test_filters_on_w_do_not_reach_the_line_items(spark, odd):
    for fixture in (fixtures.wide, fixtures.tiers, fixtures.bands):
        plan = fixture(Tables(spark, odd)).filter(F.regexp_replace("school_code", "0", "") != "")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "l_suppkey" not in plan


def test_reconcile_joins_only_rows_of_sampled_keys(spark):
    k = spark.range(20000).select(F.col("id").cast("string").alias("key"), F.lit("f").alias("source_file"), F.col("id").cast("double").alias("value"))
    sample = Q.sample_per_file(k, 5, ["key"])
    found = Q.dq_sample_reconcile(sample, k, ["key", "source_file"])
    assert [tuple(r) for r in found.collect()] == [("f", 5, 5, 5)]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_schema_check_covers_all_thirteen_sources():
    import __spark_entry__ as E
    from kpiloom.plans.q_analytics import MASTER_SOURCES
    sql = E.oracle_sql()["kpi_schema_check"]
    assert len(MASTER_SOURCES) == 13 and all(f"'{name}' AS source" in sql for name in MASTER_SOURCES)


def test_rows_of_a_year_lie_together(spark, odd):
    """Jobs over W and B then write them year by year without a shuffle of the KPI rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for fixture in (fixtures.wide_parts, fixtures.bands):
            got = fixture(Tables(spark, odd), by_year=True)
            files = got.select("school_year", F.input_file_name().alias("file")).distinct().groupBy("school_year").count().collect()
            assert len(files) > 1 and all(n == 1 for _, n in files)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sink_by_year_stores_the_same_rows(spark, odd, tmp_path):
    before = {k: spark.conf.get(k, None) for k in WRITER_SETTINGS}
    w = fixtures.wide_parts(Tables(spark, odd), by_year=True)
    for job in ("job_suspension", "job_kindergarten", "job_enrollment"):
        for by_year in (False, True):
            sink_kpi(run_spec(JOB_SPECS[job][0](), w, W_DIMS), f"file://{tmp_path}/{by_year}", job, by_year=by_year)
    assert before == {k: spark.conf.get(k, None) for k in WRITER_SETTINGS}
    stored = [_rows(read_kpi(spark, f"file://{tmp_path}/{by_year}").collect()) for by_year in (False, True)]
    assert stored[0] and stored[0] == stored[1]


def test_emission_does_not_grow_with_the_square_of_the_entries(spark):
    df = spark.createDataFrame([(1, "N", 1.0), (2, "Y", None)], "id int, suppressed string, a double")

    def emitted(n):
        entries = [Entry(f"m{i}", F.col("a") + i) for i in range(n)]
        return explode_entries(df, entries_column(entries, "row", "suppressed", [Entry(f"m{i}", F.lit(None).cast("double"), F.lit(True)) for i in range(n)]), ["id"])

    assert sorted(map(tuple, emitted(2).collect())) == [(1, "m0", 1.0, "N"), (1, "m1", 2.0, "N"), (2, "m0", None, "Y"), (2, "m1", None, "Y")]
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        size = {n: emitted(n)._jdf.queryExecution().analyzed().toString().count("coalesce") for n in (8, 32)}
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert size[32] <= 5 * size[8]
