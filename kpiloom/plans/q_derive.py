"""Row-wise derived measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.functions import derive as D
from kpiloom.operators.longform import null_marker_strings
from kpiloom.plans import sqltext as S
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_normalize import B_KEY, B_KEY_SQL, supp, SUPP_SQL, W_KEY, W_KEY_SQL
from kpiloom.plans.registry import register
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

BANDS = ["novice", "apprentice", "proficient", "distinguished"]


def _n(c):
    return S.num(S.nm(c))


def _w(spark, sf):
    return null_marker_strings(fixtures.wide(Tables(spark, sf)))


_BSUM = "(" + " + ".join(_n(b) for b in BANDS) + ")"


@register("share_of_sum", ctes("fx_b") + f"SELECT {B_KEY_SQL}, " + ", ".join(
    f"CASE WHEN {_BSUM} > 0 THEN round({_n(b)} / {_BSUM} * 100, 6) END AS {b}_share" for b in BANDS) + " FROM fx_b")
def share_of_sum_q(spark, sf):
    b = null_marker_strings(fixtures.bands(Tables(spark, sf)))
    parts = [C.parse_number(x) for x in BANDS]
    return b.select(*B_KEY, *[F.round(D.share_of_sum(p, parts), 6).alias(f"{x}_share") for p, x in zip(parts, BANDS)])


@register("count_from_rate", ctes("fx_w") + f"SELECT {W_KEY_SQL}, round_even({_n('r_rate')} / 100 * {_n('total_count')}, 0) "
          "AS r_count_estimate FROM fx_w")
def count_from_rate_q(spark, sf):
    w = _w(spark, sf)
    return w.select(*W_KEY, D.count_from_rate(C.parse_number("r_rate"), C.parse_number("total_count")).alias("r_count_estimate"))


_PART_SQL = f"CASE WHEN {SUPP_SQL} % 2 = 0 THEN {_n('r_rate')} ELSE {_n('qty_text')} END"
_TOT_SQL = f"{_n('qty_text')} * 2"


@register("rate_or_count", ctes("fx_w") + f"SELECT {W_KEY_SQL}, CASE WHEN {_PART_SQL} <= 100 THEN {_PART_SQL} "
          f"WHEN {_PART_SQL} > 100 AND {_TOT_SQL} > 0 THEN round_even({_PART_SQL} / ({_TOT_SQL}) * 100, 1) END AS participation_rate, "
          f"CASE WHEN {_PART_SQL} > 100 AND NOT COALESCE({_TOT_SQL} > 0, FALSE) THEN {_PART_SQL} END AS participation_count FROM fx_w")
def rate_or_count_q(spark, sf):
    w = _w(spark, sf)
    part = F.when(supp() % 2 == 0, C.parse_number("r_rate")).otherwise(C.parse_number("qty_text"))
    rate, count = D.rate_or_count(part, C.parse_number("qty_text") * 2)
    return w.select(*W_KEY, rate.alias("participation_rate"), count.alias("participation_count"))


_SUSP_PARTS = [_n("a_count"), _n("n_count"), _n("r_count"), f"({_n('r_count')} - {_n('a_count')})"]


@register("sum_null_as_zero", ctes("fx_w") + f"SELECT {W_KEY_SQL}, " + " + ".join(
    f"COALESCE({p}, 0.0)" for p in _SUSP_PARTS) + " AS total_count FROM fx_w")
def sum_null_as_zero_q(spark, sf):
    w = _w(spark, sf)
    a, n, r = (C.parse_number(c) for c in ("a_count", "n_count", "r_count"))
    return w.select(*W_KEY, D.sum_null_as_zero([a, n, r, r - a]).alias("total_count"))


_POS_PARTS = [f"({_n('a_count')} % 4)", f"({_n('n_count')} % 3)", f"({_n('r_count')} % 5)"]


@register("sum_positive_or_null", ctes("fx_w") + f"SELECT {W_KEY_SQL}, CASE WHEN " + " OR ".join(f"{p} > 0" for p in _POS_PARTS)
          + " THEN " + " + ".join(f"CASE WHEN {p} > 0 THEN {p} ELSE 0.0 END" for p in _POS_PARTS) + " END AS level_total FROM fx_w")
def sum_positive_or_null_q(spark, sf):
    w = _w(spark, sf)
    parts = [C.parse_number("a_count") % 4, C.parse_number("n_count") % 3, C.parse_number("r_count") % 5]
    return w.select(*W_KEY, D.sum_positive_or_null(parts).alias("level_total"))


_PRIM = f"({_n('a_count')} % 4)"


@register("first_nonzero_total", ctes("fx_w") + f"SELECT {W_KEY_SQL}, CASE WHEN COALESCE(NULLIF({_PRIM}, 0), {_n('total_count')}) > 0 "
          f"THEN COALESCE(NULLIF({_PRIM}, 0), {_n('total_count')}) END AS enrollment_total FROM fx_w")
def first_nonzero_total_q(spark, sf):
    w = _w(spark, sf)
    return w.select(*W_KEY, D.first_nonzero_total(C.parse_number("a_count") % 4, C.parse_number("total_count"))
                    .alias("enrollment_total"))


_POL = [f"policy_{i}" for i in range(1, 9)]
_ANS = "(" + " + ".join(f"CASE WHEN {p} IS NOT NULL THEN 1 ELSE 0 END" for p in _POL) + ")"
_YES = "(" + " + ".join(f"CASE WHEN upper(trim({p})) = 'YES' THEN 1 ELSE 0 END" for p in _POL) + ")"


@register("policy_compliance", ctes("fx_p") + f"SELECT school_code, district_name, CASE WHEN {_ANS} > 0 THEN "
          f"round_even({_YES} / {_ANS} * 100, 1) END AS policy_compliance_rate FROM fx_p")
def policy_compliance_q(spark, sf):
    p = fixtures.policies(Tables(spark, sf))
    return p.select("school_code", "district_name", D.policy_compliance(_POL).alias("policy_compliance_rate"))


_COMB = S.guard(_n("r_rate"), 0, 100)


@register("fan_out_combined", ctes("fx_w") + f"SELECT {W_KEY_SQL}, 'climate_index_score' AS metric, {_COMB} AS value FROM fx_w "
          f"WHERE {_COMB} IS NOT NULL UNION ALL SELECT {W_KEY_SQL}, 'safety_index_score', {_COMB} FROM fx_w WHERE {_COMB} IS NOT NULL")
def fan_out_combined_q(spark, sf):
    w = _w(spark, sf)
    rate = C.range_guard(C.parse_number("r_rate"), 0, 100)
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), rate.alias("value"))
                    for m in ("climate_index_score", "safety_index_score")])
    return w.filter(rate.isNotNull()).select(*W_KEY, F.inline(arr))
