"""Data-quality queries over K with planted violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.operators import quality as Q
from kpiloom.operators.broadcast import sized_broadcast
from kpiloom.operators.longform import null_marker_strings, with_kpi_ids
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS, W_YEARS
from kpiloom.plans.oracle_fixtures import ctes, define, kpi_cols
from kpiloom.plans.q_analytics import events_job
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import W_MEASURES, kpi_from_typed, kpi_long, typed_wide, wide_source_file, with_second_delivery
from kpiloom.schema import LOGICAL_KEY
from kpiloom.session import materialized
from kpiloom.sources import fixtures
from kpiloom.sources.local import local_table
from kpiloom.sources.tables import Tables

KPI = ", ".join(S.KPI_LIST)
KEYS = ", ".join(LOGICAL_KEY)


def planted(k):
    """K with one planted violation per rule family."""
    sid, m, s, v = F.col("school_id"), F.col("metric"), F.col("suppressed"), F.col("value")
    value = (F.when((m == "r_rate") & (s == "N") & sid.endswith("3"), F.lit(150.0))
              .when((s == "Y") & sid.endswith("7"), F.lit(1.0))
              .when((m == "a_count") & sid.endswith("5") & v.isNotNull(), v + 1)
              .otherwise(v))
    flag = F.when((m == "n_count") & (s == "N") & sid.endswith("9"), F.lit("X")).otherwise(s)
    return k.withColumns({"value": value, "suppressed": flag})


define("kdq", f"""SELECT {kpi_cols(
    value="CASE WHEN metric = 'r_rate' AND suppressed = 'N' AND ends_with(school_id, '3') THEN 150.0 "
          "WHEN suppressed = 'Y' AND ends_with(school_id, '7') THEN 1.0 "
          "WHEN metric = 'a_count' AND ends_with(school_id, '5') AND value IS NOT NULL THEN value + 1 ELSE value END",
    suppressed="CASE WHEN metric = 'n_count' AND suppressed = 'N' AND ends_with(school_id, '9') THEN 'X' ELSE suppressed END")}
FROM fx_k""", ["fx_k"])


def K(spark, sf):
    return K_of(fixtures.wide(Tables(spark, sf)))


def K_of(w):
    """K with its violations from a W that the caller reads too."""
    return planted(kpi_from_typed(typed_wide(w)))


def _kind(m="metric"):
    return (f"CASE WHEN contains({m}, 'with_bonus') THEN 'bonus_rate' WHEN regexp_matches({m}, '_rate($|_)') THEN 'rate' "
            f"WHEN regexp_matches({m}, '_(count|total)($|_)') THEN 'count' END")


@register("dq_value_range", ctes("kdq") + f"""SELECT * FROM (SELECT {KPI}, CASE
 WHEN k = 'bonus_rate' AND (value < 0 OR value >= 150) THEN 'bonus_rate_out_of_range'
 WHEN k = 'rate' AND (value < 0 OR value > 100) THEN 'rate_out_of_range'
 WHEN k = 'count' AND value < 0 THEN 'negative_count'
 WHEN k = 'count' AND value <> floor(value) THEN 'fractional_count' END AS rule
FROM (SELECT *, {_kind()} AS k FROM kdq) a) b WHERE rule IS NOT NULL""")
def dq_value_range_q(spark, sf):
    return Q.dq_value_range(K(spark, sf))


@register("dq_suppressed_null", ctes("kdq") + f"""SELECT * FROM (SELECT {KPI}, CASE
 WHEN NOT COALESCE(suppressed IN ('Y', 'N'), FALSE) THEN 'bad_flag'
 WHEN suppressed = 'Y' AND value IS NOT NULL THEN 'suppressed_with_value'
 WHEN suppressed = 'N' AND value IS NULL THEN 'reported_without_value' END AS rule FROM kdq) a WHERE rule IS NOT NULL""")
def dq_suppressed_null_q(spark, sf):
    return Q.dq_suppressed_null(K(spark, sf))


@register("dq_suppressed_share", ctes("kdq") + """
SELECT metric AS scope, count(*) AS n_rows, CAST(sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS n_suppressed,
 round(sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) / count(*), 6) AS share,
 CASE WHEN count(*) > 100 AND sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) / count(*) > 0.3 THEN 'Y' ELSE 'N' END AS over_threshold
FROM kdq GROUP BY metric
UNION ALL
SELECT 'overall', count(*), CAST(sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) AS BIGINT),
 round(sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) / count(*), 6),
 CASE WHEN sum(CASE WHEN suppressed = 'Y' THEN 1 ELSE 0 END) / count(*) > 0.4 THEN 'Y' ELSE 'N' END FROM kdq""")
def dq_suppressed_share_q(spark, sf):
    return Q.dq_suppressed_share(K(spark, sf))


define("kk2dq", f"SELECT {KPI} FROM fx_k UNION ALL SELECT {KPI} FROM fx_k2", ["fx_k", "fx_k2"])


@register("dq_duplicate_keys", ctes("kk2dq") + f"SELECT {KEYS}, count(*) AS n_rows FROM kk2dq GROUP BY {KEYS} HAVING count(*) > 1")
def dq_duplicate_keys_q(spark, sf):
    return Q.dq_duplicate_keys(with_second_delivery(kpi_long(Tables(spark, sf))))


@register("dq_school_id_stability", ctes("kdq") + """SELECT count(*) AS n_names, count(*) FILTER (WHERE n_ids > 1) AS n_unstable,
 round(count(*) FILTER (WHERE n_ids > 1) / count(*), 6) AS share_unstable,
 CASE WHEN round(count(*) FILTER (WHERE n_ids > 1) / count(*), 6) < 0.1 THEN 'Y' ELSE 'N' END AS ok
FROM (SELECT school_name, count(DISTINCT school_id) AS n_ids FROM kdq GROUP BY school_name) a""")
def dq_school_id_stability_q(spark, sf):
    return Q.dq_school_id_stability(K(spark, sf))


_RC_KEY = "district, school_id, school_name, year, student_group"


@register("dq_rate_consistency", ctes("kdq") + f"""SELECT *, round(count / total * 100, 6) AS computed,
 round(abs(rate - count / total * 100), 6) AS diff FROM (
 SELECT {_RC_KEY}, max(CASE WHEN metric = 'r_rate' THEN value END) AS rate, max(CASE WHEN metric = 'r_count' THEN value END) AS count,
  max(CASE WHEN metric = 'total_count' THEN value END) AS total
 FROM kdq WHERE metric IN ('r_rate', 'r_count', 'total_count') AND value IS NOT NULL GROUP BY {_RC_KEY}) g
WHERE total > 0 AND rate IS NOT NULL AND count IS NOT NULL AND abs(rate - count / total * 100) > 0.1""")
def dq_rate_consistency_q(spark, sf):
    return Q.dq_rate_consistency(K(spark, sf), "r_rate", "r_count", "total_count")


_PARTS = ["a_count", "n_count", "r_count"]


@register("dq_component_sum", ctes("kdq") + f"""SELECT *, round(abs(parts_sum - whole), 6) AS diff FROM (
 SELECT {_RC_KEY}, sum(CASE WHEN metric IN ('a_count', 'n_count', 'r_count') THEN value END) AS parts_sum,
  count(*) FILTER (WHERE metric IN ('a_count', 'n_count', 'r_count')) AS n_parts, max(CASE WHEN metric = 'total_count' THEN value END) AS whole
 FROM kdq WHERE metric IN ('a_count', 'n_count', 'r_count', 'total_count') AND value IS NOT NULL GROUP BY {_RC_KEY}) g
WHERE n_parts = 3 AND whole IS NOT NULL AND abs(parts_sum - whole) > 0.01""")
def dq_component_sum_q(spark, sf):
    return Q.dq_component_sum(K(spark, sf), _PARTS, "total_count")


@register("dq_tier_consistency", ctes("ev_job") + """SELECT * FROM (SELECT *, CASE
 WHEN rate IS NOT NULL AND affected > 0 AND abs(rate - events / affected) > 0.001 THEN 'rate_mismatch'
 WHEN affected > events THEN 'affected_above_events' WHEN rate < 1 THEN 'rate_below_one' END AS rule FROM (
 SELECT district, school_id, school_name, year, base_metric,
  max(CASE WHEN starts_with(metric, 'safe_students_affected_') AND student_group = 'All Students' THEN value END) AS affected,
  max(CASE WHEN starts_with(metric, 'safe_event_count_') AND student_group = 'All Students - Total Events' THEN value END) AS events,
  max(CASE WHEN starts_with(metric, 'safe_incident_rate_') THEN value END) AS rate
 FROM (SELECT *, CASE WHEN starts_with(metric, 'safe_students_affected_') THEN substr(metric, 24)
   WHEN starts_with(metric, 'safe_incident_rate_') THEN substr(metric, 20)
   WHEN starts_with(metric, 'safe_event_count_') AND NOT contains(metric, '_by_demo') THEN substr(metric, 18) END AS base_metric
  FROM ev_job) x WHERE base_metric IS NOT NULL AND value IS NOT NULL
 GROUP BY district, school_id, school_name, year, base_metric) g) r WHERE rule IS NOT NULL""")
def dq_tier_consistency_q(spark, sf):
    return Q.dq_tier_consistency(events_job(Tables(spark, sf)))


# Fixed values (fixture): the metrics expected every year, one of them never delivered.
EXPECTED_METRICS = list(W_MEASURES) + ["r_rate_4_year"]
METRIC_PAIRS = [("r_count", "total_count"), ("r_rate", "r_count")]
_EXP_ROWS = [(y, m) for y in W_YEARS for m in EXPECTED_METRICS]
define("dq_exp", S.values_cte("dq_exp_v", ["year", "metric"], _EXP_ROWS).split(" AS (", 1)[1][:-1], [])


@register("dq_metric_coverage", ctes("kdq", "dq_exp") + """SELECT year, metric, count(*) AS n_rows, 'present' AS status FROM kdq GROUP BY year, metric
UNION ALL SELECT e.year, e.metric, CAST(0 AS BIGINT), 'missing' FROM dq_exp e
 WHERE e.year IN (SELECT year FROM kdq) AND NOT EXISTS (SELECT 1 FROM kdq k WHERE k.year = e.year AND k.metric = e.metric)
UNION ALL SELECT year, pair, abs(d), 'unpaired' FROM (SELECT year, 'r_count|total_count' AS pair,
  count(*) FILTER (WHERE metric = 'r_count') - count(*) FILTER (WHERE metric = 'total_count') AS d FROM kdq GROUP BY year
 UNION ALL SELECT year, 'r_rate|r_count', count(*) FILTER (WHERE metric = 'r_rate') - count(*) FILTER (WHERE metric = 'r_count')
  FROM kdq GROUP BY year) p WHERE d <> 0""")
def dq_metric_coverage_q(spark, sf):
    exp = sized_broadcast(local_table(spark, _EXP_ROWS, "year string, metric string"), known_rows=len(_EXP_ROWS))
    k = K(spark, sf)
    return Q.dq_metric_coverage(k, exp).unionByName(Q.dq_paired_metrics(k, METRIC_PAIRS))


# Fixed values (fixture): a delivered file that holds no usable row.
PLANTED_EMPTY_FILE = "wide_empty.csv"


@register("dq_source_coverage", ctes("fx_w", "kdq") + f"""SELECT source_file FROM (
 SELECT DISTINCT 'wide_' || {S.yearx('school_year')} || '.csv' AS source_file FROM fx_w UNION SELECT '{PLANTED_EMPTY_FILE}') i
WHERE source_file NOT IN (SELECT source_file FROM kdq WHERE source_file IS NOT NULL)""")
def dq_source_coverage_q(spark, sf):
    w = fixtures.wide(Tables(spark, sf))
    inputs = w.select(wide_source_file().alias("source_file")).unionByName(
        local_table(spark, [(PLANTED_EMPTY_FILE,)], "source_file string"))
    return Q.dq_source_coverage(inputs, K_of(w))


# Fixed values (fixture): groups every year must carry.
BASIC_GROUPS = ["All Students", "TELECOM"]
_BASIC_ROWS = [(y, g) for y in W_YEARS for g in BASIC_GROUPS]
define("dq_basic", S.values_cte("x", ["year", "student_group"], _BASIC_ROWS).split(" AS (", 1)[1][:-1], [])


@register("dq_group_labels", ctes("kdq", "dq_basic") + f"""SELECT year, issue, student_group, count(*) AS n_rows FROM (
 SELECT year, student_group, CASE WHEN student_group IS NULL OR trim(student_group) = '' THEN 'null_or_empty_group'
  WHEN student_group IN {S.in_list(Q.AGGREGATE_GROUP_LABELS)} THEN 'aggregate_label' END AS issue FROM kdq) a
 WHERE issue IS NOT NULL GROUP BY year, issue, student_group
UNION ALL SELECT b.year, 'basic_group_missing', b.student_group, CAST(0 AS BIGINT) FROM dq_basic b
 WHERE b.year IN (SELECT year FROM kdq)
  AND NOT EXISTS (SELECT 1 FROM kdq k WHERE k.year = b.year AND k.student_group = b.student_group)""")
def dq_group_labels_q(spark, sf):
    basic = sized_broadcast(local_table(spark, _BASIC_ROWS, "year string, student_group string"), known_rows=len(_BASIC_ROWS))
    return Q.dq_group_labels(K(spark, sf), basic)


SAMPLE_N = 500
define("dq_sample", f"""SELECT year, school_id, student_group, 'r_count' AS metric, source_file, value FROM (
 SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY md5(concat_ws('|', COALESCE(year, ''), COALESCE(school_id, ''),
  COALESCE(student_group, ''))), year, school_id, student_group) AS rn FROM (
  SELECT year, school_id, student_group, source_file, r_count AS value FROM fx_wid WHERE suppressed = 'N' AND school_id IS NOT NULL
   AND {S.not_aggregate()}) s) r WHERE rn <= {SAMPLE_N}""", ["fx_wid"])


@register("dq_sample_reconcile", ctes("dq_sample", "kdq") + """SELECT s.source_file, count(*) AS n_sampled,
 count(*) FILTER (WHERE k.value IS NOT NULL OR s.value IS NULL) AS n_found,
 count(*) FILTER (WHERE abs(s.value - k.value) <= 0.01 OR (s.value IS NULL AND k.value IS NULL)) AS n_equal
FROM dq_sample s LEFT JOIN kdq k ON s.year = k.year AND s.school_id = k.school_id AND s.student_group = k.student_group
 AND s.metric = k.metric AND s.source_file = k.source_file GROUP BY s.source_file""")
def dq_sample_reconcile_q(spark, sf):
    from kpiloom.operators.longform import skip_aggregate_rows
    w = fixtures.wide(Tables(spark, sf))
    tw = typed_wide(w)
    ids = with_kpi_ids(skip_aggregate_rows(tw), W_DIMS, source_file=wide_source_file())
    rows = ids.filter((F.col("suppressed") == "N") & F.col("school_id").isNotNull()) \
              .select("year", "school_id", "student_group", F.lit("r_count").alias("metric"), "source_file",
                      F.col("r_count").alias("value"))
    sample = Q.sample_per_file(rows, SAMPLE_N, ["year", "school_id", "student_group"])
    return Q.dq_sample_reconcile(sample, K_of(w), ["year", "school_id", "student_group", "metric", "source_file"])


# Fixed values (fixture): complementary group pairs and groups that must not appear.
COMPLEMENT_PAIRS = [("HOUSEHOLD", "FURNITURE"), ("AUTOMOBILE", "MACHINERY")]
MIN_GROUPS = 10
REQUIRED_GROUPS = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]


@register("dq_demographic_rules", ctes("kdq") + f"""
SELECT 'min_distinct_groups' AS rule, CAST(1 AS BIGINT) AS n_checked,
 CAST(CASE WHEN count(DISTINCT student_group) < {MIN_GROUPS} THEN 1 ELSE 0 END AS BIGINT) AS n_violations FROM kdq
UNION ALL SELECT 'all_students_only_share', count(*), CAST(CASE WHEN count(*) FILTER (WHERE only_all) > 0.05 * count(*) THEN 1 ELSE 0 END AS BIGINT)
 FROM (SELECT school_id, year, bool_and(student_group = 'All Students') AS only_all FROM kdq GROUP BY school_id, year) a
UNION ALL SELECT 'complementary_pairs', count(*), count(*) FILTER (WHERE """ + " OR ".join(
    f"(h{i}a <> h{i}b)" for i in range(len(COMPLEMENT_PAIRS))) + ") FROM (SELECT school_id, year, " + ", ".join(
    f"bool_or(student_group = '{a}') AS h{i}a, bool_or(student_group = '{b}') AS h{i}b" for i, (a, b) in enumerate(COMPLEMENT_PAIRS))
    + f""" FROM kdq GROUP BY school_id, year) p
UNION ALL SELECT 'required_groups', CAST(count(*) * 4 AS BIGINT), CAST(sum(4 - n) AS BIGINT) FROM (SELECT year, count(DISTINCT student_group)
  FILTER (WHERE student_group IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')) AS n FROM kdq GROUP BY year) q
UNION ALL SELECT 'non_demographic_labels', count(*), count(*) FILTER (WHERE student_group IN {S.in_list(Q.AGGREGATE_GROUP_LABELS)}) FROM kdq""")
def dq_demographic_rules_q(spark, sf):
    k = K(spark, sf)
    g = F.col("student_group")
    r1 = k.agg(F.lit("min_distinct_groups").alias("rule"), F.lit(1).cast("bigint").alias("n_checked"),
               F.when(F.count_distinct(g) < MIN_GROUPS, 1).otherwise(0).cast("bigint").alias("n_violations"))
    per = k.groupBy("school_id", "year").agg(F.bool_and(g == "All Students").alias("only_all"),
                                             *[F.bool_or(g == x).alias(f"h{i}{s}") for i, p in enumerate(COMPLEMENT_PAIRS)
                                               for x, s in zip(p, "ab")])
    r2 = per.agg(F.lit("all_students_only_share").alias("rule"), F.count(F.lit(1)).alias("n_checked"),
                 F.when(F.count_if("only_all") > 0.05 * F.count(F.lit(1)), 1).otherwise(0).cast("bigint").alias("n_violations"))
    broken = None
    for i in range(len(COMPLEMENT_PAIRS)):
        c = F.col(f"h{i}a") != F.col(f"h{i}b")
        broken = c if broken is None else broken | c
    r3 = per.agg(F.lit("complementary_pairs").alias("rule"), F.count(F.lit(1)).alias("n_checked"),
                 F.count_if(broken).alias("n_violations"))
    r4 = k.agg(F.lit("non_demographic_labels").alias("rule"), F.count(F.lit(1)).alias("n_checked"),
               F.count_if(g.isin(Q.AGGREGATE_GROUP_LABELS)).alias("n_violations"))
    years = k.groupBy("year").agg(*[F.bool_or(g.eqNullSafe(x)).cast("int").alias(f"has{i}") for i, x in enumerate(REQUIRED_GROUPS)])
    present = sum((F.col(f"has{i}") for i in range(len(REQUIRED_GROUPS))), F.lit(0))
    r5 = years.agg(F.lit("required_groups").alias("rule"), (F.count(F.lit(1)) * len(REQUIRED_GROUPS)).alias("n_checked"),
                   F.sum(len(REQUIRED_GROUPS) - present).alias("n_violations"))
    return r1.unionByName(r2).unionByName(r3).unionByName(r4).unionByName(r5)


BANDS = ["novice", "apprentice", "proficient", "distinguished"]


_SUM_SQL = " + ".join(S.num(S.nm(b)) for b in BANDS)
_TOP_SQL = f"{S.num(S.nm('proficient'))} + {S.num(S.nm('distinguished'))}"
# planted: every thirteenth school reports a combined share that is 1 too high
_COMBINED_SQL = f"{_TOP_SQL} + CASE WHEN CAST(school_code AS BIGINT) % 13 = 0 THEN 1.0 ELSE 0.0 END"


@register("dq_band_rules", ctes("fx_b") + f"""SELECT school_year, school_code, subject, grade, band_sum AS total, 'bands_not_100' AS rule
FROM (SELECT *, {_SUM_SQL} AS band_sum FROM fx_b) x WHERE abs(band_sum - 100) > 1.0
UNION ALL SELECT school_year, school_code, subject, grade, combined, 'combined_not_sum_of_bands'
FROM (SELECT *, {_TOP_SQL} AS top, {_COMBINED_SQL} AS combined FROM fx_b) y WHERE abs(top - combined) > 0.1""")
def dq_band_rules_q(spark, sf):
    b = null_marker_strings(fixtures.bands(Tables(spark, sf)))
    novice, apprentice, proficient, distinguished = (C.parse_number(x) for x in BANDS)
    planted = F.when(F.col("school_code").cast("bigint") % 13 == 0, 1.0).otherwise(0.0)
    return Q.dq_band_rules(b.withColumn("combined", proficient + distinguished + planted), ["school_year", "school_code", "subject", "grade"],
                           [novice, apprentice, proficient, distinguished], F.col("combined"))


define("dq_new", f"SELECT {kpi_cols(value='CASE WHEN CAST(school_id AS BIGINT) % 10 = 0 THEN value + 1 ELSE value END')} "
       "FROM fx_k WHERE NOT ends_with(school_id, '7')", ["fx_k"])


_DIFF_KEY = "concat_ws(chr(1), " + ", ".join(f"COALESCE({{a}}.{c}, chr(2))" for c in LOGICAL_KEY) + ")"


@register("dq_baseline_diff", ctes("fx_k", "dq_new") + f"""SELECT * FROM (SELECT {', '.join(f'COALESCE(o.{c}, n.{c}) AS {c}' for c in LOGICAL_KEY)},
 o.value AS old_value, n.value AS new_value, o.suppressed AS old_suppressed, n.suppressed AS new_suppressed,
 CASE WHEN o.diff_key IS NULL THEN 'added' WHEN n.diff_key IS NULL THEN 'removed'
  WHEN o.value IS DISTINCT FROM n.value OR o.suppressed IS DISTINCT FROM n.suppressed THEN 'changed' END AS status
FROM (SELECT *, {_DIFF_KEY.format(a='k')} AS diff_key FROM fx_k k) o
FULL OUTER JOIN (SELECT *, {_DIFF_KEY.format(a='k')} AS diff_key FROM dq_new k) n ON o.diff_key = n.diff_key) d WHERE status IS NOT NULL""")
def dq_baseline_diff_q(spark, sf):
    k = materialized(kpi_long(Tables(spark, sf)).select(*LOGICAL_KEY, "value", "suppressed"), "baseline-run")
    new = (k.filter(~F.col("school_id").endswith("7"))
            .withColumn("value", F.when(F.col("school_id").cast("bigint") % 10 == 0, F.col("value") + 1).otherwise(F.col("value"))))
    return Q.dq_baseline_diff(k, materialized(new, "new-run"))
