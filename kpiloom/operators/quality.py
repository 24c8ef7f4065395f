"""Data-quality queries over KPI tables; each returns violations or measures.

All are grouped aggregates or filters.  The per-file sample counts rows by hash
range first and orders those of one range only; the comparison of two runs joins
only the parts whose digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.schema import LOGICAL_KEY
from kpiloom.session import materialized

# a sample's hash ranges: so many hex digits, 4,096 ranges
RANGE_DIGITS = 3
DIFF_PART = ["year", "metric"]
AGGREGATE_GROUP_LABELS = ["Total Events", "---District Total---", "District Total", "All Schools"]


def metric_kind(m: Column) -> Column:
    """'bonus_rate' / 'rate' / 'count' / null from the metric name."""
    return (F.when(m.contains("with_bonus"), F.lit("bonus_rate"))
             .when(m.rlike("_rate($|_)"), F.lit("rate"))
             .when(m.rlike("_(count|total)($|_)"), F.lit("count")))


def dq_value_range(kpi: DataFrame) -> DataFrame:
    """Rates outside 0-100 (bonus rates outside 0-150), negative or fractional counts."""
    kind, v = metric_kind(F.col("metric")), F.col("value")
    rule = (F.when((kind == "bonus_rate") & ((v < 0) | (v >= 150)), F.lit("bonus_rate_out_of_range"))
             .when((kind == "rate") & ((v < 0) | (v > 100)), F.lit("rate_out_of_range"))
             .when((kind == "count") & (v < 0), F.lit("negative_count"))
             .when((kind == "count") & (v != F.floor(v)), F.lit("fractional_count")))
    return kpi.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def dq_suppressed_null(kpi: DataFrame) -> DataFrame:
    s, v = F.col("suppressed"), F.col("value")
    rule = (F.when(~F.coalesce(s.isin("Y", "N"), F.lit(False)), F.lit("bad_flag"))
             .when((s == "Y") & v.isNotNull(), F.lit("suppressed_with_value"))
             .when((s == "N") & v.isNull(), F.lit("reported_without_value")))
    return kpi.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def dq_suppressed_share(kpi: DataFrame, overall_max: float = 0.40, metric_max: float = 0.30,
                        min_rows: int = 100) -> DataFrame:
    """Share of suppressed rows overall and per metric, with the threshold verdict."""
    supp = (F.col("suppressed") == "Y").cast("int")
    per = kpi.groupBy("metric").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(supp).alias("n_suppressed"))
    per = per.select(F.col("metric").alias("scope"), "n_rows", "n_suppressed",
                     F.round(F.try_divide(F.col("n_suppressed"), F.col("n_rows")), 6).alias("share"),
                     F.when((F.col("n_rows") > min_rows) & (F.try_divide(F.col("n_suppressed"), F.col("n_rows")) > metric_max), "Y")
                      .otherwise("N").alias("over_threshold"))
    tot = per.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_suppressed").alias("n_suppressed"))
    tot = tot.select(F.lit("overall").alias("scope"), "n_rows", "n_suppressed",
                     F.round(F.try_divide(F.col("n_suppressed"), F.col("n_rows")), 6).alias("share"),
                     F.when(F.try_divide(F.col("n_suppressed"), F.col("n_rows")) > overall_max, "Y").otherwise("N").alias("over_threshold"))
    return per.unionByName(tot)


def dq_duplicate_keys(kpi: DataFrame, key: list[str] | None = None) -> DataFrame:
    key = key or LOGICAL_KEY
    return kpi.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dq_school_id_stability(kpi: DataFrame, max_share: float = 0.10) -> DataFrame:
    per = kpi.groupBy("school_name").agg(F.count_distinct("school_id").alias("n_ids"))
    return per.agg(F.count(F.lit(1)).alias("n_names"), F.count_if(F.col("n_ids") > 1).alias("n_unstable")) \
              .withColumn("share_unstable", F.round(F.try_divide(F.col("n_unstable"), F.col("n_names")), 6)) \
              .withColumn("ok", F.when(F.col("share_unstable") < max_share, "Y").otherwise("N"))


def dq_rate_consistency(kpi: DataFrame, rate: str, count: str, total: str, tol: float = 0.1,
                        key: list[str] | None = None) -> DataFrame:
    """Rows whose rate differs from count / total * 100 by more than ``tol``."""
    key = key or ["district", "school_id", "school_name", "year", "student_group"]
    m, v = F.col("metric"), F.col("value")
    g = (kpi.filter(m.isin(rate, count, total) & v.isNotNull()).groupBy(*key)
            .agg(F.max(F.when(m == rate, v)).alias("rate"), F.max(F.when(m == count, v)).alias("count"),
                 F.max(F.when(m == total, v)).alias("total")))
    calc = F.try_divide(F.col("count"), F.col("total")) * 100
    diff = F.abs(F.col("rate") - calc)
    return (g.filter((F.col("total") > 0) & F.col("rate").isNotNull() & F.col("count").isNotNull() & (diff > tol))
             .withColumn("computed", F.round(calc, 6)).withColumn("diff", F.round(diff, 6)))


def dq_component_sum(kpi: DataFrame, parts: list[str], whole: str, tol: float = 0.01,
                     key: list[str] | None = None) -> DataFrame:
    key = key or ["district", "school_id", "school_name", "year", "student_group"]
    m, v = F.col("metric"), F.col("value")
    g = (kpi.filter(m.isin(*parts, whole) & v.isNotNull()).groupBy(*key)
            .agg(F.sum(F.when(m.isin(*parts), v)).alias("parts_sum"), F.count_if(m.isin(*parts)).alias("n_parts"),
                 F.max(F.when(m == whole, v)).alias("whole")))
    diff = F.abs(F.col("parts_sum") - F.col("whole"))
    return g.filter((F.col("n_parts") == len(parts)) & F.col("whole").isNotNull() & (diff > tol)) \
            .withColumn("diff", F.round(diff, 6))


def dq_tier_consistency(events: DataFrame, tol: float = 0.001) -> DataFrame:
    """Per (school, year, base metric): rate = events / affected, affected <= events, rate >= 1."""
    m = F.col("metric")
    base = (F.when(m.startswith("safe_students_affected_"), F.expr("substring(metric, 24)"))
             .when(m.startswith("safe_incident_rate_"), F.expr("substring(metric, 20)"))
             .when(m.startswith("safe_event_count_") & ~m.contains("_by_demo"), F.expr("substring(metric, 18)")))
    rows = events.withColumn("base_metric", base).filter(F.col("base_metric").isNotNull() & F.col("value").isNotNull())
    key = ["district", "school_id", "school_name", "year", "base_metric"]
    g = rows.groupBy(*key).agg(
        F.max(F.when(m.startswith("safe_students_affected_") & (F.col("student_group") == "All Students"), F.col("value"))).alias("affected"),
        F.max(F.when(m.startswith("safe_event_count_") & (F.col("student_group") == "All Students - Total Events"), F.col("value"))).alias("events"),
        F.max(F.when(m.startswith("safe_incident_rate_"), F.col("value"))).alias("rate"))
    a, e, r = F.col("affected"), F.col("events"), F.col("rate")
    rule = (F.when(r.isNotNull() & (a > 0) & (F.abs(r - F.try_divide(e, a)) > tol), F.lit("rate_mismatch"))
             .when(a > e, F.lit("affected_above_events"))
             .when(r < 1, F.lit("rate_below_one")))
    return g.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def dq_band_rules(df: DataFrame, key: list[str], bands: list[Column], combined: Column, tol_sum: float = 1.0,
                  tol_combined: float = 0.1) -> DataFrame:
    """Rows whose four bands don't sum to 100, and rows whose combined share is
    not the sum of the upper two bands: (key, total, rule).  Rows with a missing
    band are not judged."""
    total, top = sum(bands[1:], bands[0]), bands[2] + bands[3]
    found = F.array(F.when(F.abs(total - 100) > tol_sum, F.struct(total.alias("total"), F.lit("bands_not_100").alias("rule"))),
                    F.when(F.abs(top - combined) > tol_combined, F.struct(combined.alias("total"), F.lit("combined_not_sum_of_bands").alias("rule"))))
    return df.select(*key, F.inline(F.array_compact(found)))


def dq_metric_coverage(kpi: DataFrame, expected: DataFrame) -> DataFrame:
    """(year, metric, status, n_rows): present metrics with their rows, expected
    metrics missing from a year ('missing')."""
    present = kpi.groupBy("year", "metric").agg(F.count(F.lit(1)).alias("n_rows")) \
                 .withColumn("status", F.lit("present"))
    years = kpi.select("year").distinct()
    # the expectation lists (year, metric) pairs (configuration), restricted to
    # the years present: an equi-join, no product of years x metrics
    pairs = expected.select("year", "metric").join(years, "year", "left_semi")
    missing = (pairs.join(present.select("year", "metric"), ["year", "metric"], "left_anti")
                    .withColumn("n_rows", F.lit(0).cast("bigint")).withColumn("status", F.lit("missing")))
    return present.unionByName(missing.select("year", "metric", "n_rows", "status"))


def dq_paired_metrics(kpi: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Per year, metric pairs that must have equally many rows and don't:
    (year, metric = 'a|b', n_rows = difference, status 'unpaired')."""
    names = sorted({m for pair in pairs for m in pair})
    counts = kpi.filter(F.col("metric").isin(names)).groupBy("year").agg(*[F.count_if(F.col("metric") == m).alias(m) for m in names])
    found = F.array(*[F.struct(F.lit(f"{a}|{b}").alias("metric"), (F.col(a) - F.col(b)).alias("n_rows")) for a, b in pairs])
    return (counts.select("year", F.inline(found)).filter(F.col("n_rows") != 0)
                  .withColumns({"n_rows": F.abs("n_rows"), "status": F.lit("unpaired")}))


def dq_source_coverage(inputs: DataFrame, kpi: DataFrame) -> DataFrame:
    """Input files that produced no KPI row.  KPI rows are brought down to their files
    before the join: a few names, each with very many rows, would all meet in a few sorted tasks."""
    return inputs.select("source_file").distinct().join(kpi.select("source_file").distinct(), "source_file", "left_anti")


def dq_group_labels(kpi: DataFrame, basic: DataFrame) -> DataFrame:
    """Rows with a null / empty group, aggregate labels used as groups, and
    basic groups missing from a year: (year, issue, student_group, n_rows)."""
    g = F.col("student_group")
    bad = (F.when(g.isNull() | (F.trim(g) == ""), F.lit("null_or_empty_group"))
            .when(g.isin(AGGREGATE_GROUP_LABELS), F.lit("aggregate_label")))
    issues = (kpi.withColumn("issue", bad).filter(F.col("issue").isNotNull())
                 .groupBy("year", "issue", "student_group").agg(F.count(F.lit(1)).alias("n_rows")))
    years = kpi.select("year").distinct()
    need = basic.select("year", "student_group").join(years, "year", "left_semi")
    missing = (need.join(kpi.select("year", "student_group").distinct(), ["year", "student_group"], "left_anti")
                   .select("year", F.lit("basic_group_missing").alias("issue"), "student_group",
                           F.lit(0).cast("bigint").alias("n_rows")))
    return issues.unionByName(missing)


def sample_per_file(df: DataFrame, n: int, key_cols: list[str], file_col: str = "source_file") -> DataFrame:
    """The ``n`` rows of each file that come first in the hash order of their key,
    for any ``n``.  Rows are counted by file and hash range (partial sums); the
    counts say which ranges belong to the sample whole and which one it ends in,
    and only the rows of that last range, one in 4,096 of a file's, are ordered."""
    rows = df.withColumn("_h", F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])))
    rows = rows.withColumns({"_range": F.substring("_h", 1, RANGE_DIGITS), "_file": F.when(F.col(file_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.col(file_col)))})
    counts = rows.groupBy("_file", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # stored, so that its size is known and the rows are not shuffled to meet a few ranges
    taken = materialized(counts.withColumn("_left", F.lit(n) - before).filter("_left > 0"), "sample-ranges")
    near = rows.join(taken, ["_file", "_range"])
    whole = near.filter("_rows <= _left").select(*df.columns)
    rank = F.row_number().over(Window.partitionBy("_file", "_range").orderBy("_h", *key_cols))
    last = near.filter("_rows > _left").withColumn("_rn", rank).filter("_rn <= _left").select(*df.columns)
    return whole.unionByName(last)


def dq_sample_reconcile(sample: DataFrame, kpi: DataFrame, key: list[str], tol: float = 0.01) -> DataFrame:
    """Per file: sampled rows, rows found in the KPI table, rows with an equal value.
    The sample is stored, and only the KPI rows of its keys go on to the join."""
    sample = materialized(sample, "sample")
    k = kpi.select(*key, F.col("value").alias("kpi_value")).join(sample.select(*key), key, "left_semi")
    j = sample.join(k, key, "left")
    found = F.col("kpi_value").isNotNull() | F.col("value").isNull()
    equal = (F.abs(F.col("value") - F.col("kpi_value")) <= tol) | (F.col("value").isNull() & F.col("kpi_value").isNull())
    return j.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_sampled"), F.count_if(found).alias("n_found"),
                                        F.count_if(F.coalesce(equal, F.lit(False))).alias("n_equal"))


def run_digests(run: DataFrame, part: list[str], columns: list[str]) -> DataFrame:
    """Per part of a run: rows, and two digests of its rows whatever their order."""
    h = F.xxhash64(*(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns))
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return run.groupBy(*part).agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("mixed"), F.sum(low).alias("summed"))


def dq_baseline_diff(old: DataFrame, new: DataFrame, key: list[str] | None = None, part: list[str] | None = None,
                     old_digests: DataFrame | None = None) -> DataFrame:
    """Added / removed / changed rows between two runs.  Parts (year and metric)
    whose digests agree are left alone; only the rows of parts that differ meet, in
    a full outer join on the key, null-safe.  Both runs should be stored tables;
    ``old_digests`` are those kept with the old one."""
    key, part = key or LOGICAL_KEY, part or DIFF_PART
    columns = [*key, "value", "suppressed"]
    sides = [d.select(*part, F.col("n_rows").alias(f"{p}_rows"), F.col("mixed").alias(f"{p}_mixed"), F.col("summed").alias(f"{p}_summed"))
             for p, d in (("o", run_digests(old, part, columns) if old_digests is None else old_digests), ("n", run_digests(new, part, columns)))]
    o, n = (d.select(*[F.col(c).alias(f"{p}_{c}") for c in part], *[c for c in d.columns if c not in part]) for p, d in zip("on", sides))
    met = o.join(n, _same(part), "full_outer")
    equal = F.lit(True)
    for c in ("rows", "mixed", "summed"):
        equal &= F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    differ = materialized(met.filter(~equal).select(*[F.coalesce(f"o_{c}", f"n_{c}").alias(f"d_{c}") for c in part]), "differing-parts")

    def within(run: DataFrame, p: str) -> DataFrame:
        own = F.lit(True)
        for c in part:
            own &= run[c].eqNullSafe(F.col(f"d_{c}"))
        return run.join(differ, own, "left_semi").select(*[F.col(c).alias(f"{p}_{c}") for c in key], F.col("value").alias(f"{p}_value"),
                                                        F.col("suppressed").alias(f"{p}_suppressed"), F.lit(1).alias(f"_{p}"))

    j = within(old, "o").join(within(new, "n"), _same(key), "full_outer").select(
        *[F.coalesce(f"o_{c}", f"n_{c}").alias(c) for c in key], F.col("o_value").alias("old_value"), F.col("n_value").alias("new_value"),
        F.col("o_suppressed").alias("old_suppressed"), F.col("n_suppressed").alias("new_suppressed"), "_o", "_n")
    status = (F.when(F.col("_o").isNull(), F.lit("added")).when(F.col("_n").isNull(), F.lit("removed"))
               .when(~F.col("old_value").eqNullSafe(F.col("new_value"))
                     | ~F.col("old_suppressed").eqNullSafe(F.col("new_suppressed")), F.lit("changed")))
    return j.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_o", "_n")


def _same(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    return out
