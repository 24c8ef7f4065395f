"""Demographic mapping, audit, unmapped labels, coverage, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.operators import demographics as DM
from kpiloom.operators.demographic_rules import map_by_rules, read_rules, rule_rows, write_rules
from kpiloom.operators.longform import with_kpi_ids
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes, define
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import kpi_from_typed, kpi_long, typed_wide, wide_source_file
from kpiloom.plans import sqltext as S
from kpiloom.plans import state_labels as L
from kpiloom.session import scratch_path
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables


def mapped_w(spark, sf):
    return mapped(typed_wide(fixtures.wide(Tables(spark, sf))))


def mapped(tw):
    return with_kpi_ids(tw, W_DIMS, source_file=wide_source_file())


@register("map_demographic", ctes("fx_wid") + "SELECT year, school_id, demographic, student_group, mapping_type FROM fx_wid")
def map_demographic_q(spark, sf):
    return mapped_w(spark, sf).select("year", "school_id", "demographic", "student_group", "mapping_type")


@register("mapping_audit", ctes("fx_wid") + "SELECT mapping_type, source_file, count(*) AS n_rows "
          "FROM fx_wid GROUP BY mapping_type, source_file")
def mapping_audit_q(spark, sf):
    return DM.mapping_audit(mapped_w(spark, sf))


@register("unmapped_labels", ctes("fx_wid") + "SELECT trim(demographic) AS label, year, count(*) AS n_rows FROM fx_wid "
          "WHERE mapping_type = 'no_mapping' GROUP BY trim(demographic), year")
def unmapped_labels_q(spark, sf):
    return DM.unmapped_labels(mapped_w(spark, sf))


define("cov_act", "SELECT DISTINCT year, student_group FROM fx_k", ["fx_k"])
define("cov_status", """
SELECT a.year, 'valid' AS status, a.student_group FROM cov_act a
 WHERE EXISTS (SELECT 1 FROM dm_expected e WHERE e.year = a.year AND e.student_group = a.student_group)
UNION ALL SELECT a.year, 'unexpected', a.student_group FROM cov_act a
 WHERE NOT EXISTS (SELECT 1 FROM dm_expected e WHERE e.year = a.year AND e.student_group = a.student_group)
UNION ALL SELECT e.year, 'missing_optional', e.student_group FROM dm_expected e
 WHERE e.year IN (SELECT year FROM cov_act)
   AND NOT EXISTS (SELECT 1 FROM cov_act a WHERE a.year = e.year AND a.student_group = e.student_group)
   AND e.student_group NOT IN (SELECT student_group FROM dm_allow)
UNION ALL SELECT r.year, 'missing_required', r.student_group FROM dm_required r
 WHERE r.year IN (SELECT year FROM cov_act)
   AND NOT EXISTS (SELECT 1 FROM cov_act a WHERE a.year = r.year AND a.student_group = r.student_group)
   AND r.student_group NOT IN (SELECT student_group FROM dm_allow)""", ["cov_act", "dm"])
define("cov", """
SELECT s.year, s.status, s.student_group, COALESCE(e.n, 0) AS total_expected, a.n AS total_actual
FROM cov_status s
JOIN (SELECT year, count(*) AS n FROM cov_act GROUP BY year) a ON a.year = s.year
LEFT JOIN (SELECT year, count(*) AS n FROM dm_expected GROUP BY year) e ON e.year = s.year""", ["cov_status"])


@register("demographic_coverage", ctes("cov") + "SELECT * FROM cov")
def demographic_coverage_q(spark, sf):
    return DM.demographic_coverage(kpi_long(Tables(spark, sf)), W_DIMS)


@register("mapping_report", ctes("fx_wid", "cov") + """
SELECT 'files' AS section, CAST(NULL AS VARCHAR) AS year, source_file AS item, count(*) AS n FROM fx_wid GROUP BY source_file
UNION ALL SELECT 'mapping_types', NULL, mapping_type, count(*) FROM fx_wid GROUP BY mapping_type
UNION ALL SELECT 'coverage', year, status, count(*) FROM cov GROUP BY year, status""")
def mapping_report_q(spark, sf):
    tw = typed_wide(fixtures.wide(Tables(spark, sf)))
    cov = DM.demographic_coverage(kpi_from_typed(tw), W_DIMS)
    return DM.mapping_report(mapped(tw), cov)


# --- the state's labels as a stored table of rules ---------------------------------
# Every row of W takes one of these spellings, and a year of 2019 to 2025, by its school, year and group.
SPELLINGS = [*L.STANDARD, *(label for label, _ in L.GENERAL), *(label for *_, label, _ in L.BY_YEAR),
             "MALE", " Female ", "aSIAN", "iep", "non english learner", "", "Some New Category"]
define("spelled", f"""SELECT year, CASE pick {' '.join(f"WHEN {i} THEN {S.q(x)}" for i, x in enumerate(SPELLINGS))} END AS demographic FROM
 (SELECT CAST(2019 + CAST(school_code AS BIGINT) % 7 AS VARCHAR) AS year,
  (CAST(school_code AS BIGINT) * 13 + CAST(substr(school_year, 5, 4) AS BIGINT) * 5 + length(COALESCE(demographic, ''))) % {len(SPELLINGS) + 1} AS pick FROM fx_w) p""", ["fx_w"])


@register("demographic_rules", ctes("spelled") + f""", rules AS (
 SELECT 1 AS precedence, 'standard' AS kind, label, label AS mapped, 0 AS since, 9999 AS until, FALSE AS any_case, 0 AS place FROM (VALUES {', '.join(f'({S.q(x)})' for x in L.STANDARD)}) s(label)
 UNION ALL SELECT 2, 'year_specific', label, mapped, since, until, FALSE, 0 FROM (VALUES {', '.join(f'({a}, {b}, {S.q(x)}, {S.q(m)})' for a, b, x, m in L.BY_YEAR)}) y(since, until, label, mapped)
 UNION ALL SELECT 3, 'general', label, mapped, 0, 9999, FALSE, 0 FROM (VALUES {', '.join(f'({S.q(x)}, {S.q(m)})' for x, m in L.GENERAL)}) g(label, mapped)
 UNION ALL SELECT 4, 'case_insensitive', label, mapped, 0, 9999, TRUE, place FROM (VALUES {', '.join(f'({S.q(x)}, {S.q(m)}, {i})' for i, (x, m) in enumerate(L.GENERAL))}) c(label, mapped, place)),
 pairs AS (SELECT year, demographic, count(*) AS n_rows FROM spelled GROUP BY year, demographic),
 best AS (SELECT p.year, p.demographic, min_by(r.mapped, r.precedence * 1000 + r.place) AS mapped, min_by(r.kind, r.precedence * 1000 + r.place) AS kind
  FROM pairs p JOIN rules r ON CASE WHEN r.any_case THEN lower(r.label) = lower(trim(p.demographic)) ELSE r.label = trim(p.demographic) END
   AND CAST(p.year AS INT) BETWEEN r.since AND r.until GROUP BY p.year, p.demographic)
SELECT p.year, p.demographic, CASE WHEN COALESCE(p.demographic, '') = '' THEN 'All Students' ELSE COALESCE(b.mapped, trim(p.demographic)) END AS student_group,
 CASE WHEN COALESCE(p.demographic, '') = '' THEN 'default' ELSE COALESCE(b.kind, 'no_mapping') END AS mapping_type, p.n_rows
FROM pairs p LEFT JOIN best b ON p.year = b.year AND p.demographic = b.demographic""")
def demographic_rules_q(spark, sf):
    path = scratch_path(spark, "demographic-rules")
    write_rules(spark, rule_rows(L.STANDARD, L.GENERAL[:5], []), path)
    write_rules(spark, rule_rows(L.STANDARD, L.GENERAL, L.BY_YEAR), path)
    school = F.col("school_code").cast("bigint")
    pick = (school * 13 + F.substring("school_year", 5, 4).cast("bigint") * 5 + F.length(F.coalesce("demographic", F.lit("")))) % (len(SPELLINGS) + 1)
    spelled = fixtures.wide(Tables(spark, sf)).select((2019 + school % 7).cast("string").alias("year"),
                                                      F.get(F.array(*map(F.lit, SPELLINGS)), pick.cast("int")).alias("demographic"))
    ruled = map_by_rules(spelled, read_rules(spark, path))
    return ruled.groupBy("year", "demographic", "student_group", "mapping_type").agg(F.count(F.lit(1)).alias("n_rows"))


define("state_k", "SELECT DISTINCT year, demographic AS student_group FROM spelled WHERE COALESCE(demographic, '') <> ''", ["spelled"])


@register("state_coverage", ctes("state_k") + f""", expected(year, student_group) AS (VALUES {', '.join(f'({S.q(y)}, {S.q(g)})' for y, g in L.STATE_DIMS.expected)}),
 required(student_group) AS (VALUES {', '.join(f'({S.q(g)})' for g in L.REQUIRED)}), allowed(student_group) AS (VALUES {', '.join(f'({S.q(g)})' for g in L.ALLOW_MISSING)}),
 status AS (SELECT k.year, CASE WHEN e.year IS NULL THEN 'unexpected' ELSE 'valid' END AS status, k.student_group
   FROM state_k k LEFT JOIN expected e ON k.year = e.year AND k.student_group = e.student_group
  UNION ALL SELECT e.year, 'missing_optional', e.student_group FROM expected e WHERE e.student_group NOT IN (SELECT student_group FROM allowed)
   AND e.year IN (SELECT year FROM state_k) AND NOT EXISTS (SELECT 1 FROM state_k k WHERE k.year = e.year AND k.student_group = e.student_group)
  UNION ALL SELECT y.year, 'missing_required', r.student_group FROM required r, (SELECT DISTINCT year FROM state_k WHERE year BETWEEN '2020' AND '2024') y
   WHERE r.student_group NOT IN (SELECT student_group FROM allowed) AND NOT EXISTS (SELECT 1 FROM state_k k WHERE k.year = y.year AND k.student_group = r.student_group))
SELECT s.*, CAST(COALESCE((SELECT count(*) FROM expected e WHERE e.year = s.year), 0) AS BIGINT) AS total_expected,
 (SELECT count(*) FROM state_k k WHERE k.year = s.year) AS total_actual FROM status s""")
def state_coverage_q(spark, sf):
    spelled = demographic_rules_q(spark, sf).filter("coalesce(demographic, '') <> ''").select("year", F.col("demographic").alias("student_group"))
    return DM.demographic_coverage(spelled, L.STATE_DIMS)
