"""Climate exports end to end: survey, policy and score fixtures are written as
CSV with the source's headers, and must give the rows of the fixture's job."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.operators.columns import COMMON_HEADERS
from kpiloom.plans import climate_exports as X
from kpiloom.plans.dims import W_DIMS
from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.q_analytics import dedupe_sql
from kpiloom.plans.q_exports import CSV
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import W_IDS
from kpiloom.session import scratch_path
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables


def write_climate_exports(spark, sf: str) -> str:
    """Scores before 1998 are combined rates of accountability profiles in the historical
    spelling; policies, a file without a year or group, stand in the new one."""
    root = scratch_path(spark, "export-climate")
    t = Tables(spark, sf)
    headers = {**COMMON_HEADERS, **X.CLIMATE_HEADERS}
    year = F.substring("school_year", 5, 4)

    def write(df, columns, old, delivery):
        named = [F.col(given).alias(headers[c][-1 if old else 0]) for c, given in columns.items()]
        (df.select(*named, delivery.alias("delivery")).hint("rebalance", "delivery")
         .write.mode("append").options(**CSV).partitionBy("delivery").csv(root))

    ids = ["school_year", "district_name", "school_code", "co_op"]
    write(fixtures.survey(t), {c: c for c in [*ids, "question_type", "question_index"]}, False, F.concat(F.lit("survey_"), year, F.lit(".csv")))
    answers = {c: f"policy_{i}" for i, c in enumerate(X.POLICY_HEADERS, 1)}
    write(fixtures.policies(t), {"school_code": "school_code", "district_name": "district_name", **answers}, False, F.lit("precautionary_measures_2024.csv"))
    w = fixtures.wide_parts(t, [*W_IDS, "suppressed", "a_rate", "r_rate"])
    own = {c: c for c in [*W_IDS, "suppressed"]}
    write(w.filter(year < "1998"), {**own, "climate_safety_combined_rate": "r_rate"}, True, F.concat(F.lit("accountability_"), year, F.lit(".csv")))
    write(w.filter(year >= "1998"), {**own, "climate_index": "a_rate", "safety_index": "r_rate"}, False, F.concat(F.lit("index_scores_"), year, F.lit(".csv")))
    return root


@register("export_climate", ctes("cl_all") + dedupe_sql("cl_all"))
def export_climate_q(spark, sf):
    return X.climate_export_job(spark, f"{write_climate_exports(spark, sf)}/*/*.csv", W_DIMS, level="folder")
