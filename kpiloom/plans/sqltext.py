"""SQL text (DuckDB dialect) mirroring the column functions, for the oracles.

These strings are only the independent check of the Spark plans; nothing in
the library executes them.
"""

from __future__ import annotations

from kpiloom.functions.clean import (ALL_NULL_TOKENS, DEFAULT_YEAR, FLAG_YES, NUMBER_PATTERN)
from kpiloom.operators.demographics import DemographicDims
from kpiloom.operators.longform import AGGREGATE_LABELS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def nm(x: str) -> str:
    return f"CASE WHEN {x} IN {in_list(ALL_NULL_TOKENS)} THEN NULL ELSE {x} END"


def num(x: str) -> str:
    s = f"trim(regexp_replace(CAST({x} AS VARCHAR), '[,\"%*]', '', 'g'))"
    return f"CASE WHEN regexp_full_match({s}, {q(NUMBER_PATTERN)}) THEN CAST({s} AS DOUBLE) END"


def guard(x: str, lo=None, hi=None) -> str:
    conds = []
    if lo is not None:
        conds.append(f"{x} >= {lo}")
    if hi is not None:
        conds.append(f"{x} <= {hi}")
    return f"CASE WHEN {' AND '.join(conds) or 'TRUE'} THEN {x} END"


def yearx(x: str, default: str = DEFAULT_YEAR) -> str:
    return (f"CASE WHEN length(CAST({x} AS VARCHAR)) = 8 THEN substr(CAST({x} AS VARCHAR), 5, 4) "
            f"WHEN length(CAST({x} AS VARCHAR)) = 4 THEN CAST({x} AS VARCHAR) ELSE {q(default)} END")


def sid(x: str) -> str:
    s = f"regexp_replace(trim(CAST({x} AS VARCHAR)), '\\.0$', '')"
    return f"CASE WHEN {s} <> '' THEN {s} END"


def sname(x: str) -> str:
    return (f"CASE WHEN trim({x}) IS NULL THEN 'Unknown School' WHEN trim({x}) = 'All Schools' "
            f"THEN '---District Total---' ELSE trim({x}) END")


def flag(x: str) -> str:
    return f"CASE WHEN upper(trim(CAST({x} AS VARCHAR))) IN {in_list(FLAG_YES)} THEN 'Y' ELSE 'N' END"


def not_aggregate(label: str = "demographic") -> str:
    return f"{label} IS NOT NULL AND {label} NOT IN {in_list(AGGREGATE_LABELS)}"


def values_cte(name: str, cols: list[str], rows: list[tuple]) -> str:
    if not rows:
        sel = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
        return f"{name} AS (SELECT {sel} WHERE FALSE)"
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def dims_ctes(d: DemographicDims, p: str = "dm") -> list[str]:
    return [
        values_cte(f"{p}_std", ["label"], d.standard_rows()),
        values_cte(f"{p}_ymap", ["year", "label", "mapped"], d.year_rows()),
        values_cte(f"{p}_gmap", ["label", "mapped"], d.general_rows()),
        values_cte(f"{p}_ci", ["lkey", "mapped"], d.case_insensitive_rows()),
        values_cte(f"{p}_expected", ["year", "student_group"], list(dict.fromkeys(d.expected))),
        values_cte(f"{p}_required", ["year", "student_group"], d.required_rows()),
        values_cte(f"{p}_allow", ["student_group"], [(x,) for x in dict.fromkeys(d.allow_missing)]),
    ]


def mapping_select(src: str, p: str = "dm", label: str = "demographic", year: str = "year") -> str:
    """SELECT src.*, student_group, mapping_type FROM src with the four left joins."""
    lab = f"trim(x.{label})"
    empty = f"(x.{label} IS NULL OR x.{label} = '')"
    return f"""SELECT x.*,
 CASE WHEN {empty} THEN 'All Students' WHEN s.label IS NOT NULL THEN {lab} WHEN y.mapped IS NOT NULL THEN y.mapped
      WHEN g.mapped IS NOT NULL THEN g.mapped WHEN c.mapped IS NOT NULL THEN c.mapped ELSE {lab} END AS student_group,
 CASE WHEN {empty} THEN 'default' WHEN s.label IS NOT NULL THEN 'standard' WHEN y.mapped IS NOT NULL THEN 'year_specific'
      WHEN g.mapped IS NOT NULL THEN 'general' WHEN c.mapped IS NOT NULL THEN 'case_insensitive' ELSE 'no_mapping' END AS mapping_type
FROM {src} x
LEFT JOIN {p}_std s ON s.label = {lab}
LEFT JOIN {p}_ymap y ON y.year = CAST(x.{year} AS VARCHAR) AND y.label = {lab}
LEFT JOIN {p}_gmap g ON g.label = {lab}
LEFT JOIN {p}_ci c ON c.lkey = lower({lab})"""


KPI_OUT = ("year, metric, district, school_name, student_group, value, suppressed, county_number, "
           "county_name, district_number, school_id, school_code, state_school_id, nces_id, co_op, "
           "co_op_code, school_type, source_file")


def unpivot(src: str, items: list[tuple[str, str]], extra: str = "") -> str:
    """UNION ALL of one select per (metric name SQL, value SQL)."""
    parts = [f"SELECT *, {m} AS metric_name, CAST({v} AS DOUBLE) AS metric_value, {i} AS entry_no{extra} FROM {src}"
             for i, (m, v) in enumerate(items)]
    return "\nUNION ALL ".join(parts)


# --- generic KPI pipeline (oracle side) -------------------------------------
NULL_S = "CAST(NULL AS VARCHAR)"
PASSTHROUGH = ["county_number", "county_name", "district_number", "school_code", "state_school_id",
               "nces_id", "co_op", "co_op_code", "school_type"]
KPI_LIST = ["year", "metric", "district", "school_name", "student_group", "value", "suppressed", "county_number",
            "county_name", "district_number", "school_id", "school_code", "state_school_id", "nces_id", "co_op",
            "co_op_code", "school_type", "source_file"]


def ids_select(src_cols: list[str], year_sql: str, source_file_sql: str, measures: list[str],
               district_sql: str = "district_name", flag_sql: str = "suppressed") -> str:
    """Select list of the id template over a prepared wide CTE."""
    have = set(src_cols)
    parts = [f"{year_sql} AS year", f"{district_sql} AS district", f"{sid('school_code') if 'school_code' in have else NULL_S} AS school_id",
             f"{sname('school_name') if 'school_name' in have else sname(NULL_S)} AS school_name",
             f"{'demographic' if 'demographic' in have else NULL_S} AS demographic", f"{flag_sql} AS suppressed"]
    parts += [f"{c if c in have else NULL_S} AS {c}" for c in PASSTHROUGH]
    parts.append(f"{source_file_sql} AS source_file")
    parts += measures
    return ", ".join(parts)


def emit(src: str, entries: list[tuple], policy: str = "row", defaults: list[tuple] | None = None) -> str:
    """Emission policy over a CTE carrying the id template + student_group.

    entries: (metric_sql, value_sql[, keep_sql]); defaults: (metric_sql[, keep_sql])."""
    ents = []
    for e in entries:
        m, v = e[0], f"CAST({e[1]} AS DOUBLE)"
        k = e[2] if len(e) > 2 and e[2] is not None else f"({v}) IS NOT NULL"
        ents.append((m, v, f"COALESCE({k}, FALSE)"))
    has_any = "(" + " OR ".join(k for _, _, k in ents) + ")"
    base = [c for c in KPI_LIST if c not in ("metric", "value")]
    parts = [f"SELECT {', '.join(base)}, CAST({m} AS VARCHAR) AS metric, {v} AS value, {k} AS _keep, {has_any} AS _has_any, 0 AS _dflt FROM {src}"
             for m, v, k in ents]
    for d in (defaults or []):
        m = d[0]
        k = f"COALESCE({d[1]}, FALSE)" if len(d) > 1 and d[1] is not None else "TRUE"
        parts.append(f"SELECT {', '.join(base)}, CAST({m} AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value, {k} AS _keep, "
                     f"{has_any} AS _has_any, 1 AS _dflt FROM {src}")
    u = "(" + "\nUNION ALL ".join(parts) + ") u"
    sel = {c: c for c in KPI_LIST}
    if policy == "row":
        sel["value"] = "CASE WHEN suppressed = 'Y' THEN NULL ELSE value END"
        where = ("(_dflt = 0 AND _keep AND (suppressed = 'Y' OR value IS NOT NULL)) OR "
                 "(_dflt = 1 AND suppressed = 'Y' AND NOT _has_any AND _keep)")
    elif policy == "metric":
        sel["value"] = "CASE WHEN _dflt = 0 AND value >= 0 THEN value END"
        sel["suppressed"] = "CASE WHEN _dflt = 0 AND value >= 0 THEN 'N' ELSE 'Y' END"
        where = "(_dflt = 0 AND _keep) OR (_dflt = 1 AND suppressed = 'Y' AND NOT _has_any AND _keep)"
    elif policy == "always":
        sel["value"] = "CASE WHEN suppressed = 'Y' THEN NULL ELSE value END"
        sel["suppressed"] = "CASE WHEN suppressed = 'Y' THEN 'Y' ELSE 'N' END"
        where = "_dflt = 0"
    else:
        raise ValueError(policy)
    cols = ", ".join(f"{sel[c]} AS {c}" for c in KPI_LIST)
    return f"SELECT {cols} FROM {u} WHERE school_id IS NOT NULL AND ({where})"
