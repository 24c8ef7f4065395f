"""Event exports end to end: the tier fixture is written as CSV, a year in each
of the six formats (the seventh year in the first one again), and scanned."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.operators.columns import COMMON_HEADERS
from kpiloom.plans import event_exports as E
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes, define
from kpiloom.plans.q_analytics import KPI, rate_sql
from kpiloom.plans.q_exports import CSV
from kpiloom.plans.q_long import T_IDS, T_VALUES
from kpiloom.plans.registry import register
from kpiloom.session import scratch_path
from kpiloom.sources import fixtures
from kpiloom.sources.csv_io import scan_raw_csv
from kpiloom.sources.tables import Tables

_TOTAL, _GRADES = ["total_events"], list(E.GRADE_HEADERS)
# year modulo 6 -> (measures of the year's file, 0 newest or 1 historical spelling)
DELIVERED = [
    (list(E.TYPE_HEADERS), 0),
    (_TOTAL + list(E.LOCATION_HEADERS), 0),
    (_TOTAL + list(E.CONTEXT_HEADERS), 0),
    (_TOTAL + [g for g in _GRADES if g != "preschool"], 0),
    (_GRADES, 1),
    ([*E.TYPE_HEADERS, *E.LOCATION_HEADERS, *E.CONTEXT_HEADERS], 1),
]


def write_event_exports(spark, sf: str) -> str:
    """One folder a year; measure i carries column i modulo 3 of the fixture."""
    root = scratch_path(spark, "export-events")
    t = fixtures.tiers(Tables(spark, sf))
    bound = {m: T_VALUES[i % len(T_VALUES)] for i, m in enumerate(E.EVENT_HEADERS)}
    year = F.substring("school_year", 5, 4)
    for i, (measures, spelling) in enumerate(DELIVERED):
        named = [F.col(c).alias(COMMON_HEADERS[c][-spelling]) for c in T_IDS]
        named += [F.col(bound[m]).alias(E.EVENT_HEADERS[m][spelling]) for m in measures]
        (t.filter(year.cast("int") % len(DELIVERED) == i).select(*named, F.concat(F.lit("events_"), year, F.lit(".csv")).alias("delivery"))
         .hint("rebalance", "delivery").write.mode("append").options(**CSV).partitionBy("delivery").csv(root))
    return root


# Written out anew for the oracle: stems in order, with the years (modulo 6) that deliver them.
_STEMS = ([("total", "0, 1, 2, 3, 5")] + [(s, "0, 5") for s in ("alcohol", "assault_1st", "drugs", "harassment", "assault_other", "other_state", "tobacco", "weapons")]
          + [("all_grades", "3, 4"), ("preschool", "4"), ("kindergarten", "3, 4")] + [(f"grade_{g}", "3, 4") for g in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14)]
          + [(s, "1, 5") for s in ("classroom", "bus", "hallway", "cafeteria", "restroom", "gymnasium", "playground", "other_location", "campus")]
          + [(s, "2, 5") for s in ("school_sponsored_during", "school_sponsored_after", "non_school_sponsored_during", "non_school_after")])
_YEAR6 = "CAST(substr(school_year, 5, 4) AS INTEGER) % 6"
_LABEL = ("CASE {y} WHEN 0 THEN 'kyrc24_events_by_type' WHEN 1 THEN 'kyrc24_events_by_location' WHEN 2 THEN 'kyrc24_events_by_context' "
          "WHEN 3 THEN 'kyrc24_events_by_grade' WHEN 4 THEN 'historical_events_by_grade' ELSE 'historical_event_details' END").format(y=_YEAR6)
_FILE = f"'safe_schools_events_' || {_LABEL} || CASE tier WHEN 1 THEN '_students_affected' WHEN 3 THEN '_total_events' ELSE '' END"
_COLUMNS = ["total_events", "alpha_events", "return_events"]
_KEEP = ["metric_prefix", "metric_suffix", "tier_group", f"{_YEAR6} AS y6"]
define("evx_ids", f"SELECT {S.ids_select(T_IDS, S.yearx('school_year'), _FILE, [*_COLUMNS, *_KEEP], flag_sql=chr(39) + 'N' + chr(39))} FROM ev_prep", ["ev_prep"])
define("evx_map", S.mapping_select("evx_ids"), ["evx_ids", "dm"])
define("evx_fix", f"SELECT * REPLACE (COALESCE(tier_group, student_group) AS student_group, COALESCE(school_id, {S.sid('state_school_id')}) AS school_id) FROM evx_map",
       ["evx_map"])
define("evx_long", S.emit("evx_fix", [(f"metric_prefix || '{s}' || metric_suffix", _COLUMNS[i % 3], f"y6 IN ({years})") for i, (s, years) in enumerate(_STEMS)], "metric"),
       ["evx_fix"])
define("evx_rate", rate_sql("evx_long"), ["evx_long"])


@register("export_events", ctes("evx_rate") + f"SELECT {KPI} FROM evx_long UNION ALL SELECT {KPI} FROM evx_rate")
def export_events_q(spark, sf):
    return E.event_export_job(spark, f"{write_event_exports(spark, sf)}/*/*.csv", W_DIMS)


@register("detect_event_format", ctes("fx_t") + f"SELECT {_LABEL} AS data_format, count(*) AS n_rows FROM fx_t GROUP BY 1")
def detect_event_format_q(spark, sf):
    raw = scan_raw_csv(spark, f"{write_event_exports(spark, sf)}/*/*.csv")
    return raw.select(E.delivered().alias("delivered")).groupBy(E.event_format("delivered").alias("data_format")).agg(F.count(F.lit(1)).alias("n_rows"))
