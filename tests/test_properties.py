"""Properties over the driver tables at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "value" in df.columns and "metric" in df.columns


def test_suppressed_iff_null(spark):
    k = E.queries()["wide_to_long"](spark, SF001)
    bad = k.filter(((F.col("suppressed") == "Y") & F.col("value").isNotNull())
                   | ((F.col("suppressed") == "N") & F.col("value").isNull())).count()
    assert bad == 0


def test_union_counts_add_up(spark):
    q = E.queries()
    m = q["union_master"](spark, SF001)
    per = {r.source: r.n for r in m.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(per) == 13
    for source, job in (("graduation_rates", "job_graduation"), ("student_enrollment", "job_enrollment"), ("safe_schools_events", "job_events")):
        assert per[source] == q[job](spark, SF001).count()


def test_batch_equals_stream(spark):
    q = E.queries()
    batch = q["wide_to_long"](spark, SF001)
    stream = q["stream_kpi_ingest"](spark, SF001)
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_every_key_of_the_survey_has_an_oracle():
    from kpiloom.plans.catalog import oracles, queries
    assert set(queries()) == set(oracles())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_registry_loads_without_spark():
    """oracle_sql() / queries() must be listable in a process without a SparkContext."""
    import subprocess
    import sys
    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    root = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    n_q, n_o = map(int, out.stdout.split()[-2:])
    assert n_q >= n_o >= 104
