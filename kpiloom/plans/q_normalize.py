"""Projections, filters and flags over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import labels as L
from kpiloom.operators import columns as COL
from kpiloom.operators.longform import null_marker_strings, quarantine_rows, skip_aggregate_rows
from kpiloom.plans import sqltext as S
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import W_MEASURES, kpi_long
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

W_KEY = ["school_year", "school_code", "demographic"]
W_KEY_SQL = ", ".join(W_KEY)
W_TEXT = ["total_count", "a_count", "n_count", "r_count", "qty_text", "r_rate"]
B_KEY = ["school_year", "school_code", "subject", "grade"]
B_KEY_SQL = ", ".join(B_KEY)
def supp():
    """School number of a fixture row (built on use: Columns need a running Spark)."""
    return F.col("school_code").cast("bigint")
SUPP_SQL = "CAST(school_code AS BIGINT)"


def W(spark, sf):
    return fixtures.wide(Tables(spark, sf))


# --- header drift ------------------------------------------------------------
# Fixed values (fixture): raw header spellings of W, newest and historical.
W_HEADERS_NEW = {"school_year": "School Year", "county_name": "County Name", "district_name": "District Name",
                 "school_code": "School Code", "school_name": "School Name", "demographic": "Demographic",
                 "suppressed": "Suppressed", "total_count": "Total Count", "a_count": "A Count",
                 "n_count": "N Count", "r_count": "R Count", "qty_text": "Quantity", "r_rate": "R Rate"}
W_HEADERS_OLD = {"school_year": "SCHOOL YEAR", "county_name": "COUNTY NAME", "district_name": "DISTRICT NAME",
                 "school_code": "SCHOOL CODE", "school_name": "SCHOOL NAME", "demographic": "DEMOGRAPHIC",
                 "suppressed": "SUPPRESSED", "total_count": "TOTAL COUNT", "a_count": "A COUNT",
                 "n_count": "N COUNT", "r_count": "R COUNT", "qty_text": "QUANTITY", "r_rate": "PERCENT R"}
W_SOURCE_HEADERS = {k: [W_HEADERS_NEW[k], W_HEADERS_OLD[k]] for k in W_TEXT}


def raw_headers(w):
    """W as two deliveries with different headers, stacked by name (ragged)."""
    old = F.substring("school_year", 5, 4) < "1998"
    a = w.filter(old).select(*[F.col(k).alias(v) for k, v in W_HEADERS_OLD.items()])
    b = w.filter(~old).select(*[F.col(k).alias(v) for k, v in W_HEADERS_NEW.items()])
    return a.unionByName(b, allowMissingColumns=True)


@register("rename_columns", ctes("fx_w") + "SELECT * FROM fx_w")
def rename_columns_q(spark, sf):
    return COL.rename_columns(raw_headers(W(spark, sf)), W_SOURCE_HEADERS)


# Fixed values (fixture): T headers as printed, to be snake_cased.
T_HEADERS = {"school_year": "School Year", "county_name": "County Name", "district_name": "District Name",
             "school_code": "School Code", "school_name": "School Name", "demographic": "Demographic",
             "total_events": "Total Events", "alpha_events": "Alpha Events (A)",
             "return_events": "Return-Events", "state_school_id": "stateSchoolId"}


@register("snake_case_columns", ctes("fx_t") + "SELECT school_year, county_name, district_name, school_code, school_name, "
          "demographic, total_events, alpha_events AS alpha_events_a, return_events, state_school_id FROM fx_t")
def snake_case_q(spark, sf):
    t = fixtures.tiers(Tables(spark, sf))
    return COL.snake_case_columns(t.select(*[F.col(k).alias(v) for k, v in T_HEADERS.items()]))


# --- markers, numbers, bounds ---------------------------------------------------
_W_ALL = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic", "suppressed"] + W_TEXT


@register("null_markers", ctes("fx_w") + "SELECT " + ", ".join(f"{S.nm(c)} AS {c}" for c in _W_ALL) + " FROM fx_w")
def null_markers_q(spark, sf):
    return null_marker_strings(W(spark, sf))


_PARSED = {m: src for m, (src, _, _) in W_MEASURES.items()}


@register("parse_number", ctes("fx_w") + f"SELECT {W_KEY_SQL}, " + ", ".join(
    f"{S.num(S.nm(src))} AS {m}" for m, src in _PARSED.items()) + " FROM fx_w")
def parse_number_q(spark, sf):
    w = null_marker_strings(W(spark, sf))
    return w.select(*W_KEY, *[C.parse_number(src).alias(m) for m, src in _PARSED.items()])


_RR = S.num(S.nm("r_rate"))
_DIFF = f"({S.num(S.nm('r_count'))} - {S.num(S.nm('a_count'))})"


@register("range_guard", ctes("fx_w") + f"SELECT {W_KEY_SQL}, {S.guard(_RR, 20, 50)} AS r_rate_guarded, "
          f"{S.guard(_DIFF, 0)} AS r_minus_a_guarded FROM fx_w")
def range_guard_q(spark, sf):
    w = null_marker_strings(W(spark, sf))
    rr = C.parse_number("r_rate")
    diff = C.parse_number("r_count") - C.parse_number("a_count")
    return w.select(*W_KEY, C.range_guard(rr, 20, 50).alias("r_rate_guarded"),
                    C.range_guard(diff, 0).alias("r_minus_a_guarded"))


@register("range_guard_rejects", ctes("fx_w") + f"SELECT count(*) FILTER (WHERE {_RR} IS NOT NULL AND {S.guard(_RR, 20, 50)} IS NULL) AS r_rate_rejected, "
          f"count(*) FILTER (WHERE {_DIFF} IS NOT NULL AND {S.guard(_DIFF, 0)} IS NULL) AS r_minus_a_rejected FROM fx_w")
def range_guard_rejects_q(spark, sf):
    w = null_marker_strings(W(spark, sf))
    rr = C.parse_number("r_rate")
    diff = C.parse_number("r_count") - C.parse_number("a_count")
    return w.agg(F.count_if(C.out_of_range(rr, 20, 50)).alias("r_rate_rejected"),
                 F.count_if(C.out_of_range(diff, 0)).alias("r_minus_a_rejected"))


# Fixed values (fixture): configured dtypes, renames and constants.
W_DTYPES = {"total_count": "Int64", "a_count": "float64", "qty_text": "Int64", "r_rate": "float64", "school_code": "str"}
W_RENAMES = {"qty_text": "quantity_text", "r_rate": "return_rate_text"}
W_DERIVE = {"processing_date": "2025-07-18", "data_quality_flag": "reviewed"}


def _sql_cast(c: str, dt: str) -> str:
    s = f"trim(CAST({c} AS VARCHAR))"
    n = f"CASE WHEN regexp_full_match({s}, {S.q(C.NUMBER_PATTERN)}) THEN CAST({s} AS DOUBLE) END"
    if dt.lower().startswith("int"):
        return f"CASE WHEN {n} = floor({n}) THEN CAST({n} AS BIGINT) END"
    if dt.lower().startswith("float"):
        return n
    return f"CAST({c} AS VARCHAR)"


@register("cast_by_config", ctes("fx_w") + f"SELECT {W_KEY_SQL}, " + ", ".join(
    f"{_sql_cast(S.nm(c), dt)} AS {c}_typed" for c, dt in W_DTYPES.items()) + " FROM fx_w")
def cast_by_config_q(spark, sf):
    w = null_marker_strings(W(spark, sf))
    typed = COL.cast_by_config(w, W_DTYPES)
    return typed.select(*W_KEY, *[F.col(c).alias(f"{c}_typed") for c in W_DTYPES])


@register("rename_by_config", ctes("fx_w") + "SELECT school_year, school_code, demographic, qty_text AS quantity_text, "
          "r_rate AS return_rate_text FROM fx_w")
def rename_by_config_q(spark, sf):
    w = COL.rename_by_config(W(spark, sf), W_RENAMES)
    return w.select(*W_KEY, "quantity_text", "return_rate_text")


@register("derive_constants", ctes("fx_w") + f"SELECT {W_KEY_SQL}, '2025-07-18' AS processing_date, "
          "'reviewed' AS data_quality_flag, 'wide' AS data_source FROM fx_w")
def derive_constants_q(spark, sf):
    w = COL.derive_constants(W(spark, sf), W_DERIVE, source_name="wide")
    return w.select(*W_KEY, "processing_date", "data_quality_flag", "data_source")


# --- years, ids, names ----------------------------------------------------------
_SY_IN = (f"CASE WHEN {SUPP_SQL} % 9 = 0 THEN substr(school_year, 5, 4) WHEN {SUPP_SQL} % 9 = 1 "
          "THEN 'SY' || school_year WHEN " + SUPP_SQL + " % 9 = 2 THEN NULL ELSE school_year END")


def _sy_in():
    return (F.when(supp() % 9 == 0, F.substring("school_year", 5, 4))
             .when(supp() % 9 == 1, F.concat(F.lit("SY"), F.col("school_year")))
             .when(supp() % 9 == 2, F.lit(None).cast("string"))
             .otherwise(F.col("school_year")))


_FILE_SQL = "'file_' || substr(school_year, 1, 4) || '.csv'"
_VARIANT_SQL = (f"CASE WHEN length(trim(sy)) >= 4 THEN right(trim(sy), 4) "
                f"ELSE NULLIF(regexp_extract(file_name, '(20\\d{{2}})', 1), '') END")


@register("year_from_school_year", ctes("fx_w") + f"SELECT {W_KEY_SQL}, sy AS school_year_in, {S.yearx('sy')} AS year, "
          f"{_VARIANT_SQL} AS year_from_file FROM (SELECT *, {_SY_IN} AS sy, {_FILE_SQL} AS file_name FROM fx_w) x")
def year_q(spark, sf):
    w = W(spark, sf).withColumn("sy", _sy_in()) \
        .withColumn("file_name", F.concat(F.lit("file_"), F.substring("school_year", 1, 4), F.lit(".csv")))
    return w.select(*W_KEY, F.col("sy").alias("school_year_in"), C.year_from_school_year("sy").alias("year"),
                    C.year_from_text_or_file("sy", "file_name").alias("year_from_file"))


_SID_IN = (f"CASE WHEN {SUPP_SQL} % 13 = 0 THEN '' WHEN {SUPP_SQL} % 3 = 0 THEN ' ' || school_code || '.0' "
           f"WHEN {SUPP_SQL} % 3 = 1 THEN school_code || ' ' ELSE school_code END")


@register("clean_school_id", ctes("fx_w") + f"SELECT {W_KEY_SQL}, {S.sid('raw_id')} AS school_id FROM "
          f"(SELECT *, {_SID_IN} AS raw_id FROM fx_w) x")
def clean_school_id_q(spark, sf):
    raw = (F.when(supp() % 13 == 0, F.lit(""))
            .when(supp() % 3 == 0, F.concat(F.lit(" "), F.col("school_code"), F.lit(".0")))
            .when(supp() % 3 == 1, F.concat(F.col("school_code"), F.lit(" ")))
            .otherwise(F.col("school_code")))
    return W(spark, sf).select(*W_KEY, C.clean_school_id(raw).alias("school_id"))


_SN_IN = (f"CASE WHEN {SUPP_SQL} % 7 = 0 THEN NULL WHEN {SUPP_SQL} % 7 = 1 THEN 'All Schools' "
          f"WHEN {SUPP_SQL} % 7 = 2 THEN ' ' || school_name || ' ' ELSE school_name END")


@register("standardize_school_name", ctes("fx_w") + f"SELECT {W_KEY_SQL}, {S.sname('raw_name')} AS school_name FROM "
          f"(SELECT school_year, school_code, demographic, {_SN_IN} AS raw_name FROM fx_w) x")
def school_name_q(spark, sf):
    raw = (F.when(supp() % 7 == 0, F.lit(None).cast("string"))
            .when(supp() % 7 == 1, F.lit("All Schools"))
            .when(supp() % 7 == 2, F.concat(F.lit(" "), F.col("school_name"), F.lit(" ")))
            .otherwise(F.col("school_name")))
    return W(spark, sf).select(*W_KEY, C.standardize_school_name(raw).alias("school_name"))


# --- grade, level, subject ------------------------------------------------------
def _sql_map(x: str, d: dict[str, str], fallback: str) -> str:
    whens = " ".join(f"WHEN {x} = {S.q(k)} THEN {S.q(v)}" for k, v in d.items())
    return f"CASE {whens} ELSE {fallback} END"


def sql_grade(x: str) -> str:
    g = f"trim({x})"
    return (f"CASE WHEN {g} IS NULL OR {g} = '' THEN 'all_grades' "
            f"WHEN regexp_full_match({g}, '^[0-9]+$') THEN 'grade_' || CAST(CAST({g} AS INTEGER) AS VARCHAR) "
            f"ELSE {_sql_map(g, L.GRADE_NAMES, f'replace(lower({g}), chr(32), chr(95))')} END")


def sql_level(x: str, unknown: str | None = "all") -> str:
    v = f"trim({x})"
    fb = S.q(unknown) if unknown is not None else f"replace(lower({v}), ' ', '_')"
    return f"CASE WHEN {v} IS NULL OR {v} = '' THEN 'all' ELSE {_sql_map(v, L.LEVEL_NAMES, fb)} END"


def sql_subject(x: str) -> str:
    v = f"trim({x})"
    return (f"CASE WHEN {v} IS NULL OR {v} = '' THEN 'unknown_subject' "
            f"ELSE {_sql_map(v, L.SUBJECT_NAMES, f'replace(lower({v}), chr(32), chr(95))')} END")


def sql_grade_to_level(g: str) -> str:
    part = f"split_part({g}, '_', 2)"
    n = f"CASE WHEN starts_with({g}, 'grade_') AND regexp_full_match({part}, '^[0-9]+$') THEN CAST({part} AS INTEGER) END"
    return (f"CASE WHEN {n} >= 9 THEN 'high' WHEN {n} >= 6 THEN 'middle' WHEN {n} IS NOT NULL THEN 'elementary' "
            f"WHEN {g} IN {S.in_list(L.ELEMENTARY_NAMED)} THEN 'elementary' ELSE 'all' END")


def level_text():
    return F.when(F.col("subject") == "MA", "ES").when(F.col("subject") == "Reading", "MS").otherwise("HS")


LEVEL_TEXT_SQL = "CASE WHEN subject = 'MA' THEN 'ES' WHEN subject = 'Reading' THEN 'MS' ELSE 'HS' END"


def B(spark, sf):
    return fixtures.bands(Tables(spark, sf))


@register("normalize_grade", ctes("fx_b") + f"SELECT {B_KEY_SQL}, {sql_grade('grade')} AS grade_norm FROM fx_b")
def normalize_grade_q(spark, sf):
    return B(spark, sf).select(*B_KEY, L.normalize_grade("grade").alias("grade_norm"))


@register("normalize_level", ctes("fx_b") + f"SELECT {B_KEY_SQL}, {sql_level(LEVEL_TEXT_SQL)} AS level_el, "
          f"{sql_level('subject', None)} AS level_slug FROM fx_b")
def normalize_level_q(spark, sf):
    return B(spark, sf).select(*B_KEY, L.normalize_level(level_text()).alias("level_el"),
                               L.normalize_level("subject", None).alias("level_slug"))


@register("normalize_subject", ctes("fx_b") + f"SELECT {B_KEY_SQL}, {sql_subject('subject')} AS subject_norm FROM fx_b")
def normalize_subject_q(spark, sf):
    return B(spark, sf).select(*B_KEY, L.normalize_subject("subject").alias("subject_norm"))


@register("grade_to_level", ctes("fx_b") + f"SELECT {B_KEY_SQL}, {sql_grade_to_level(sql_grade('grade'))} AS level FROM fx_b")
def grade_to_level_q(spark, sf):
    return B(spark, sf).select(*B_KEY, L.grade_to_level(L.normalize_grade("grade")).alias("level"))


def sql_slug(x: str) -> str:
    s = f"regexp_replace(trim(lower({x})), '[ /\\-]', '_', 'g')"
    s = f"regexp_replace(replace({s}, '__', '_'), '[^\\p{{L}}\\p{{N}}_]', '', 'g')"
    return f"CASE WHEN {x} IS NULL THEN 'unknown' ELSE {s} END"


_SLUG_IN_SQL = "demographic || ' - ' || district_name || '/' || county_name"


@register("slugify", ctes("fx_w") + f"SELECT {W_KEY_SQL}, {sql_slug(_SLUG_IN_SQL)} AS slug FROM fx_w")
def slugify_q(spark, sf):
    raw = F.concat("demographic", F.lit(" - "), "district_name", F.lit("/"), "county_name")
    return W(spark, sf).select(*W_KEY, C.slugify(raw).alias("slug"))


# --- filters and flags -----------------------------------------------------------
@register("skip_aggregate_rows", ctes("fx_t") + f"SELECT * FROM fx_t WHERE {S.not_aggregate()}")
def skip_aggregate_q(spark, sf):
    return skip_aggregate_rows(fixtures.tiers(Tables(spark, sf)))


@register("suppression_flag", ctes("fx_w") + f"SELECT {W_KEY_SQL}, suppressed AS flag_in, {S.flag('suppressed')} AS flag FROM fx_w")
def suppression_flag_q(spark, sf):
    return W(spark, sf).select(*W_KEY, F.col("suppressed").alias("flag_in"), C.suppression_flag("suppressed").alias("flag"))


@register("infer_suppression", ctes("fx_w") + f"SELECT {W_KEY_SQL}, CASE WHEN ({S.num(S.nm('r_rate'))} IS NULL AND "
          f"demographic IS NOT NULL) OR COALESCE({S.num(S.nm('total_count'))}, {S.num(S.nm('a_count'))}) IS NULL "
          "THEN 'Y' ELSE 'N' END AS suppressed FROM fx_w")
def infer_suppression_q(spark, sf):
    w = null_marker_strings(W(spark, sf))
    return w.select(*W_KEY, C.infer_suppression(C.parse_number("r_rate"), "demographic",
                                                [C.parse_number("total_count"), C.parse_number("a_count")]).alias("suppressed"))


_FLAG_IN_SQL = f"CASE WHEN {SUPP_SQL} % 4 = 0 THEN 'Y' ELSE {S.flag('suppressed')} END"
_HAS_DATA_SQL = "COALESCE(" + ", ".join(f"CAST({S.num(S.nm(c))} AS VARCHAR)" for c in W_TEXT) + ") IS NOT NULL"


def planted_flag():
    return F.when(supp() % 4 == 0, F.lit("Y")).otherwise(C.suppression_flag("suppressed"))


@register("override_suppression", ctes("fx_w") + f"SELECT {W_KEY_SQL}, {_FLAG_IN_SQL} AS flag_in, "
          f"CASE WHEN {_FLAG_IN_SQL} = 'Y' AND {_HAS_DATA_SQL} THEN 'N' ELSE {_FLAG_IN_SQL} END AS flag FROM fx_w")
def override_suppression_q(spark, sf):
    w = W(spark, sf).withColumn("flag_in", planted_flag())
    w = null_marker_strings(w)
    return w.select(*W_KEY, "flag_in",
                    C.override_suppression("flag_in", [C.parse_number(c) for c in W_TEXT]).alias("flag"))


@register("filter_district_contains", ctes("fx_k") + "SELECT * FROM fx_k WHERE lower(district) LIKE '%nation_1%'")
def filter_district_q(spark, sf):
    from kpiloom.operators.dashboard import filter_district_contains
    return filter_district_contains(kpi_long(Tables(spark, sf)), "NATION_1")


_QUAR_SQL = f"CASE WHEN {SUPP_SQL} % 11 = 0 THEN NULL ELSE school_code END"


@register("quarantine_rows", ctes("fx_w") + f"SELECT {W_KEY_SQL}, raw_code, CASE WHEN {S.sid('raw_code')} IS NULL THEN 'missing_school_id' "
          f"WHEN {S.num(S.nm('qty_text'))} IS NULL AND {S.nm('qty_text')} IS NOT NULL THEN 'unparsable_value' END AS reject_reason "
          f"FROM (SELECT *, {_QUAR_SQL} AS raw_code FROM fx_w) x WHERE {S.sid('raw_code')} IS NULL "
          f"OR ({S.num(S.nm('qty_text'))} IS NULL AND {S.nm('qty_text')} IS NOT NULL)")
def quarantine_q(spark, sf):
    w = W(spark, sf).withColumn("raw_code", F.when(supp() % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("school_code")))
    qty = C.null_markers("qty_text")
    _, bad = quarantine_rows(w, {"missing_school_id": C.clean_school_id("raw_code").isNull(),
                                 "unparsable_value": C.parse_number(qty).isNull() & qty.isNotNull()})
    return bad.select(*W_KEY, "raw_code", "reject_reason")
