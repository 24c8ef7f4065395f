"""Minimum slice: the long KPI table K of the W fixture."""

from __future__ import annotations

from kpiloom.plans.oracle_fixtures import ctes
from kpiloom.plans.registry import register
from kpiloom.plans.wide_kpi import kpi_long
from kpiloom.sources.tables import Tables


@register("wide_to_long", ctes("fx_k") + "SELECT * FROM fx_k")
def wide_to_long_q(spark, sf_dir):
    return kpi_long(Tables(spark, sf_dir))
