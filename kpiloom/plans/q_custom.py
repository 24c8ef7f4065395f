"""Extension surface: a user-registered source spec.

A user describes a new export with Column expressions only: the typed-wide
preparation, the metric entries (names may be Columns), suppressed defaults
and the emission policy.  ``run_spec`` supplies everything else.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.functions import clean as C
from kpiloom.operators.longform import Entry
from kpiloom.plans import sqltext as S
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import define, kpi_cols, pipeline
from kpiloom.plans.registry import register
from kpiloom.plans.specs import SourceSpec, run_spec
from kpiloom.plans.wide_kpi import W_IDS
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables


def user_spec() -> SourceSpec:
    def prepare(w):
        total, r, qty = C.parse_number("total_count"), C.parse_number("r_count"), C.parse_number("qty_text")
        return w.select(*W_IDS, C.suppression_flag("suppressed").alias("suppressed"),
                        C.range_guard(F.when(total > 0, F.try_divide(r, total) * 100), 0, 100).alias("return_share"),
                        F.when(total > 0, F.try_divide(qty, total)).alias("quantity_per_line"))

    return SourceSpec(
        "user_returns", prepare,
        entries=lambda: [Entry("user_return_share", F.col("return_share")),
                         Entry(F.concat(F.lit("user_quantity_per_line_"), F.substring("school_year", 5, 4)),
                               F.col("quantity_per_line"))],
        defaults=lambda: ["user_return_share"],
        policy="row",
        source_file=lambda: F.concat(F.lit("user_"), F.substring("school_year", 5, 4), F.lit(".csv")))


_t, _r, _q = S.num("total_count"), S.num("r_count"), S.num("qty_text")
_c = pipeline("cust", f"{', '.join(W_IDS)}, {S.flag('suppressed')} AS suppressed, "
              f"{S.guard(f'CASE WHEN {_t} > 0 THEN {_r} / {_t} * 100 END', 0, 100)} AS return_share, "
              f"CASE WHEN {_t} > 0 THEN {_q} / {_t} END AS quantity_per_line", "fx_wn", ["fx_wn"],
              W_IDS + ["suppressed"], ["return_share", "quantity_per_line", "school_year"],
              [("'user_return_share'", "return_share"),
               ("'user_quantity_per_line_' || substr(school_year, 5, 4)", "quantity_per_line")], "row",
              [("'user_return_share'",)], source_file_sql="'user_' || substr(school_year, 5, 4) || '.csv'")


@register("custom_source_spec", _c[0] + _c[1])
def custom_source_spec_q(spark, sf):
    return run_spec(user_spec(), fixtures.wide(Tables(spark, sf)), W_DIMS)


def hooked_spec() -> SourceSpec:
    """All three hooks: groups under 12 are skipped, those under 20 suppressed and
    districts renamed in the id template, shares converted to per mille."""
    def prepare(w):
        total, r = C.parse_number("total_count"), C.parse_number("r_count")
        return w.select(*W_IDS, C.suppression_flag("suppressed").alias("suppressed"), total.alias("total"),
                        C.range_guard(F.when(total > 0, F.try_divide(r, total) * 100), 0, 100).alias("return_share"))

    def id_template(typed, template):
        small = F.col("total") < 20
        return template(typed).withColumns({"suppressed": F.when(small, F.lit("Y")).otherwise(F.col("suppressed")),
                                            "district": F.concat(F.lit("Area "), F.col("district"))})

    def convert(ids, emit):
        return emit(ids).withColumns({"value": F.col("value") * 10, "metric": F.concat(F.col("metric"), F.lit("_per_mille"))})

    return SourceSpec("user_hooks", prepare, entries=lambda: [Entry("user_return_share", F.col("return_share"))], defaults=lambda: ["user_return_share"],
                      skip=lambda default: default | (F.col("total") < 12), id_template=id_template, convert=convert)


define("hk_src", f"SELECT * FROM fx_wn WHERE NOT COALESCE({_t} < 12, FALSE)", ["fx_wn"])
_AREA, _PER_MILLE = "'Area ' || district", "metric || '_per_mille'"
_h = pipeline("hooks", f"{', '.join(W_IDS)}, CASE WHEN {_t} < 20 THEN 'Y' ELSE {S.flag('suppressed')} END AS suppressed, "
              f"{S.guard(f'CASE WHEN {_t} > 0 THEN {_r} / {_t} * 100 END', 0, 100)} AS return_share", "hk_src", ["hk_src"],
              W_IDS + ["suppressed"], ["return_share", "school_year"], [("'user_return_share'", "return_share")], "row", [("'user_return_share'",)],
              source_file_sql="'source_' || substr(school_year, 5, 4) || '.csv'")


@register("custom_source_hooks", f"{_h[0]}SELECT {kpi_cols(district=_AREA, metric=_PER_MILLE, value='value * 10')} FROM ({_h[1]}) h")
def custom_source_hooks_q(spark, sf):
    return run_spec(hooked_spec(), fixtures.wide(Tables(spark, sf)), W_DIMS)
