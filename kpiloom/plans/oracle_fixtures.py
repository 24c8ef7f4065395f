"""The fixtures as DuckDB CTEs (same shapes as ``kpiloom.sources.fixtures``)."""

from __future__ import annotations

from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.sqltext import dims_ctes, flag, guard, mapping_select, nm, not_aggregate, num, sid, sname, unpivot, yearx
from kpiloom.plans.wide_kpi import W_MEASURES

_SCHOOL = ("CAST(yr-1 AS VARCHAR)||CAST(yr AS VARCHAR) AS school_year, county AS county_name, district AS district_name, "
           "lpad(CAST(supp AS VARCHAR),6,'0') AS school_code, 'School '||CAST(supp AS VARCHAR) AS school_name")

FX: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _def(name: str, body: str, deps: list[str]) -> None:
    once = "MATERIALIZED " if name in ("fx_base", "fx_k") else ""  # read by many parts of a query
    FX[name] = f"{name} AS {once}(\n{body}\n)"
    DEPS[name] = deps


_def("fx_base", """SELECT CAST(year(o.o_orderdate) AS INT) AS yr, r.r_name AS county, n.n_name AS district, s.s_suppkey AS supp,
 c.c_mktsegment AS seg, o.o_custkey AS cust, l.l_returnflag AS rf, l.l_linenumber AS ln, l.l_quantity AS q
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN nation n ON s.s_nationkey=n.n_nationkey
JOIN region r ON n.n_regionkey=r.r_regionkey""", [])

_def("fx_wp", f"""SELECT {_SCHOOL},
 CASE WHEN seg IS NULL THEN 'All Students' WHEN seg='AUTOMOBILE' AND yr<1998 THEN 'automobile' WHEN seg='BUILDING' AND yr=2001 THEN 'Bldg'
  WHEN seg='HOUSEHOLD' AND yr>=2000 THEN 'HOUSEHOL' WHEN seg='MACHINERY' AND yr=1996 THEN 'Mystery Group' ELSE seg END AS demographic,
 CASE WHEN n<10 THEN 'Yes' ELSE 'No' END AS suppressed,
 CASE WHEN n<10 THEN '*' ELSE CAST(n AS VARCHAR) END AS total_count,
 CASE WHEN n<10 THEN '*' ELSE CAST(a AS VARCHAR) END AS a_count,
 CASE WHEN n<10 THEN '*' ELSE CAST(nn AS VARCHAR) END AS n_count,
 CASE WHEN n<10 THEN '*' ELSE CAST(r AS VARCHAR) END AS r_count,
 CASE WHEN n<10 THEN '*' ELSE format('{{:,}}', qty) END AS qty_text,
 CASE WHEN n<10 THEN '---' ELSE CAST(round(1e2*r/n,1) AS VARCHAR)||'%' END AS r_rate,
 CASE WHEN n<10 THEN '---' ELSE CAST(round(1e2*a/n,1) AS VARCHAR)||'%' END AS a_rate,
 {', '.join(f"CASE WHEN n<10 THEN '*' ELSE CAST(b{i} AS VARCHAR) END AS part_{i}" for i in range(15))}
FROM (SELECT yr,county,district,supp,seg,count(*) AS n,
 count(*) FILTER (WHERE rf='A') AS a, count(*) FILTER (WHERE rf='N') AS nn, count(*) FILTER (WHERE rf='R') AS r,
 CAST(sum(q)*100 AS BIGINT) AS qty,
 {', '.join(f"count(*) FILTER (WHERE floor((q-1)*15/50)={i}) AS b{i}" for i in range(15))}
 FROM fx_base GROUP BY GROUPING SETS ((yr,county,district,supp,seg),(yr,county,district,supp))) g""", ["fx_base"])

_def("fx_w", "SELECT school_year, county_name, district_name, school_code, school_name, demographic, suppressed, total_count, "
     "a_count, n_count, r_count, qty_text, r_rate FROM fx_wp", ["fx_wp"])

_def("fx_t", f"""SELECT {_SCHOOL}, demographic, CAST(t AS VARCHAR) AS total_events,
 CASE WHEN a<2 THEN '*' ELSE CAST(a AS VARCHAR) END AS alpha_events, CAST(r AS VARCHAR) AS return_events,
 CASE WHEN supp%10=0 THEN NULL ELSE 'S'||CAST(supp AS VARCHAR) END AS state_school_id
FROM (
 SELECT yr,county,district,supp,seg AS demographic,count(*) AS t,count(*) FILTER (WHERE rf='A') AS a,count(*) FILTER (WHERE rf='R') AS r FROM fx_base GROUP BY yr,county,district,supp,seg
 UNION ALL SELECT yr,county,district,supp,'All Students',count(DISTINCT cust),count(DISTINCT CASE WHEN rf='A' THEN cust END),count(DISTINCT CASE WHEN rf='R' THEN cust END) FROM fx_base GROUP BY yr,county,district,supp
 UNION ALL SELECT yr,county,district,supp,'All Students',2*count(DISTINCT cust),2*count(DISTINCT CASE WHEN rf='A' THEN cust END),2*count(DISTINCT CASE WHEN rf='R' THEN cust END) FROM fx_base WHERE supp%50=0 GROUP BY yr,county,district,supp
 UNION ALL SELECT yr,county,district,supp,'Total Events',count(*),count(*) FILTER (WHERE rf='A'),count(*) FILTER (WHERE rf='R') FROM fx_base GROUP BY yr,county,district,supp) g""", ["fx_base"])

_def("fx_s", """SELECT '20232024' AS school_year, 'D'||CAST(user_id%5 AS VARCHAR) AS district_name, lpad(CAST(user_id%50 AS VARCHAR),6,'0') AS school_code,
 CASE WHEN user_id%7=0 THEN NULL ELSE 'C'||CAST(user_id%3 AS VARCHAR) END AS co_op,
 CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN ' climate ' WHEN 'error' THEN 'S' WHEN 'signup' THEN 'Safety' END AS question_type,
 CASE WHEN event_id%17=0 THEN '*' WHEN event_id%19=0 THEN '' ELSE CAST(value AS VARCHAR) END AS question_index FROM events""", [])

_def("fx_b", f"""SELECT {_SCHOOL}, 'All Students' AS demographic, subject, grade, CASE WHEN n<5 THEN 'Y' ELSE 'N' END AS suppressed,
 CASE WHEN n<5 THEN '*' ELSE CAST(round(1e2*b1/n) AS VARCHAR) END AS novice, CASE WHEN n<5 THEN '*' ELSE CAST(round(1e2*b2/n) AS VARCHAR) END AS apprentice,
 CASE WHEN n<5 THEN '*' ELSE CAST(round(1e2*b3/n) AS VARCHAR) END AS proficient, CASE WHEN n<5 THEN '*' ELSE CAST(round(1e2*b4/n) AS VARCHAR) END AS distinguished
FROM (SELECT yr,county,district,supp,CASE rf WHEN 'A' THEN 'MA' WHEN 'N' THEN 'Reading' ELSE 'Science' END AS subject,
 CASE ln%5 WHEN 0 THEN '03' WHEN 1 THEN 'Grade 7' WHEN 2 THEN '11' WHEN 3 THEN 'All Grades' ELSE NULL END AS grade,
 count(*) AS n,count(*) FILTER (WHERE q<=12) AS b1,count(*) FILTER (WHERE q>12 AND q<=25) AS b2,count(*) FILTER (WHERE q>25 AND q<=38) AS b3,count(*) FILTER (WHERE q>38) AS b4
 FROM fx_base GROUP BY yr,county,district,supp,rf,ln%5) g""", ["fx_base"])

_def("fx_p", "SELECT lpad(CAST(p_partkey AS VARCHAR),6,'0') AS school_code, p_brand AS district_name, " + ", ".join(
    f"CASE (p_partkey+{i}*p_size)%5 WHEN 0 THEN 'Yes' WHEN 1 THEN ' yes ' WHEN 2 THEN 'YES' WHEN 3 THEN 'No' END AS policy_{i}"
    for i in range(1, 9)) + " FROM part", [])

# K: typed W, ids, mapping, row-policy emission -----------------------------
_W_IDS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic"]
_def("fx_wt", "SELECT " + ", ".join(f"{nm(c)} AS {c}" for c in _W_IDS) + f", {flag(nm('suppressed'))} AS suppressed, "
     + ", ".join(f"{guard(num(nm(src)), lo, hi)} AS {m}" for m, (src, lo, hi) in W_MEASURES.items()) + " FROM fx_w", ["fx_w"])

_NULLS = "CAST(NULL AS VARCHAR)"
_def("fx_wy", f"""SELECT {yearx('school_year')} AS year, district_name AS district, {sid('school_code')} AS school_id,
 {sname('school_name')} AS school_name, demographic, suppressed, {_NULLS} AS county_number, county_name, {_NULLS} AS district_number,
 school_code, {_NULLS} AS state_school_id, {_NULLS} AS nces_id, {_NULLS} AS co_op, {_NULLS} AS co_op_code, {_NULLS} AS school_type,
 'wide_' || {yearx('school_year')} || '.csv' AS source_file,
 {', '.join(W_MEASURES)}, COALESCE({', '.join(W_MEASURES)}) IS NOT NULL AS has_any
FROM fx_wt WHERE {not_aggregate()}""", ["fx_wt"])

_def("fx_wid", mapping_select("fx_wy"), ["fx_wy", "dm"])
_def("fx_ke", unpivot("fx_wid", [(f"'{m}'", m) for m in W_MEASURES]), ["fx_wid"])

KPI_COLS_SQL = ["year", "metric", "district", "school_name", "student_group", "value", "suppressed", "county_number",
                "county_name", "district_number", "school_id", "school_code", "state_school_id", "nces_id", "co_op",
                "co_op_code", "school_type", "source_file"]


def kpi_cols(**over: str) -> str:
    return ", ".join(f"{over[c]} AS {c}" if c in over else c for c in KPI_COLS_SQL)


def row_policy(src: str) -> str:
    """Row-policy emission over an unpivoted CTE with metric_name / metric_value / has_any."""
    value = "CASE WHEN suppressed = 'Y' THEN NULL ELSE metric_value END"
    return (f"SELECT {kpi_cols(metric='metric_name', value=value)} "
            f"FROM {src} WHERE school_id IS NOT NULL AND ((suppressed = 'N' AND metric_value IS NOT NULL) "
            f"OR (suppressed = 'Y' AND (metric_value IS NOT NULL OR NOT has_any)))")


_def("fx_k", row_policy("fx_ke"), ["fx_ke"])
_def("fx_k2", f"SELECT {kpi_cols(value='value + 1', source_file="'z_' || source_file")} "
     "FROM fx_k WHERE CAST(school_id AS BIGINT) % 10 = 0", ["fx_k"])

FX_DIMS = ",\n".join(dims_ctes(W_DIMS, "dm"))


def define(name: str, body: str, deps: list[str]) -> str:
    """Register an extra CTE (used by query modules); returns its name."""
    _def(name, body, deps)
    return name


def ctes(*names: str) -> str:
    """'WITH ...' for the named CTEs and everything they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [FX_DIMS if n == "dm" else FX[n] for n in order]
    return "WITH " + ",\n".join(parts) + "\n"


# --- generic source pipeline (oracle side) ------------------------------------
W_IDS_SQL = ", ".join(f"{nm(c)} AS {c}" for c in _W_IDS)
W_FLAG_SQL = flag(nm("suppressed"))
DEFAULT_SOURCE_FILE_SQL = "'source_' || substr(school_year, 5, 4) || '.csv'"


def pipeline(name: str, prep_select: str, prep_from: str, prep_deps: list[str], prep_cols: list[str],
             measures: list[str], entries: list[tuple], policy: str = "row", defaults: list[tuple] | None = None,
             source_file_sql: str = DEFAULT_SOURCE_FILE_SQL, skip: bool = True,
             year_sql: str | None = None) -> tuple[str, str]:
    """(WITH-clause, SELECT) of a source: prepare -> ids -> mapping -> emission."""
    from kpiloom.plans.sqltext import emit, ids_select
    define(f"{name}_prep", f"SELECT {prep_select} FROM {prep_from}", prep_deps)
    where = f" WHERE {not_aggregate()}" if skip else ""
    define(f"{name}_ids", f"SELECT {ids_select(prep_cols, year_sql or yearx('school_year'), source_file_sql, measures)} "
           f"FROM {name}_prep{where}", [f"{name}_prep"])
    define(f"{name}_map", mapping_select(f"{name}_ids"), [f"{name}_ids", "dm"])
    return ctes(f"{name}_map"), emit(f"{name}_map", entries, policy, defaults)
