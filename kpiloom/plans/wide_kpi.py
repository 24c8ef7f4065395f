"""The minimum slice: W -> markers -> numbers -> bounds -> mapping -> long KPI (K),
and the second delivery K'."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.clean import parse_number, range_guard, suppression_flag, year_from_school_year
from kpiloom.operators.demographics import DemographicDims
from kpiloom.operators.longform import (Entry, null_marker_strings, skip_aggregate_rows,
                                        wide_to_long, with_kpi_ids)
from kpiloom.plans.dims import W_DIMS
from kpiloom.sources import fixtures
from kpiloom.sources.tables import Tables

W_IDS = ["school_year", "county_name", "district_name", "school_code", "school_name", "demographic"]
# metric -> (W column, lower bound, upper bound)
W_MEASURES = {
    "total_count": ("total_count", 0, None),
    "a_count": ("a_count", 0, None),
    "n_count": ("n_count", 0, None),
    "r_count": ("r_count", 0, None),
    "qty_total": ("qty_text", 0, None),
    "r_rate": ("r_rate", 0, 100),
}


def typed_wide(w: DataFrame) -> DataFrame:
    """W after null_markers, parse_number, range_guard and the flag."""
    w = null_marker_strings(w)
    return w.select(*W_IDS, suppression_flag("suppressed").alias("suppressed"),
                    *[range_guard(parse_number(src), lo, hi).alias(m)
                      for m, (src, lo, hi) in W_MEASURES.items()])


def wide_source_file() -> F.Column:
    return F.concat(F.lit("wide_"), year_from_school_year("school_year"), F.lit(".csv"))


def kpi_from_typed(tw: DataFrame, dims: DemographicDims = W_DIMS) -> DataFrame:
    ids = with_kpi_ids(skip_aggregate_rows(tw), dims, source_file=wide_source_file())
    entries = [Entry(m, F.col(m)) for m in W_MEASURES]
    return wide_to_long(ids, entries, "row", defaults=list(W_MEASURES))


def kpi_long(t: Tables, dims: DemographicDims = W_DIMS) -> DataFrame:
    """K: the long KPI table of the W fixture."""
    return kpi_from_typed(typed_wide(fixtures.wide(t)), dims)


def kpi_second_delivery(k: DataFrame) -> DataFrame:
    """K': rows of schools whose number is a multiple of 10, value + 1, file 'z_' prefix."""
    return (k.filter(F.col("school_id").cast("bigint") % 10 == 0)
             .withColumn("value", F.col("value") + 1)
             .withColumn("source_file", F.concat(F.lit("z_"), F.col("source_file"))))


def with_second_delivery(k: DataFrame) -> DataFrame:
    """K union K' in one pass over K: each row is emitted, and rows of schools
    whose number is a multiple of 10 also emit their second-delivery copy
    (value + 1, 'z_' file), so K is computed once instead of once per branch."""
    cols = k.columns
    copy = {"value": F.col("value") + 1, "source_file": F.concat(F.lit("z_"), F.col("source_file"))}
    orig = F.struct(*[F.col(c) for c in cols])
    second = F.struct(*[copy.get(c, F.col(c)).alias(c) for c in cols])
    due = F.coalesce(F.col("school_id").cast("bigint") % 10 == 0, F.lit(False))
    return k.select(F.inline(F.when(due, F.array(orig, second)).otherwise(F.array(orig))))
