"""The long KPI table: fixed 19-column schema, logical key, empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The output column order of every KPI table.
KPI_COLUMNS = [
    "year", "metric", "district", "school_name", "student_group", "value", "suppressed",
    "county_number", "county_name", "district_number", "school_id", "school_code",
    "state_school_id", "nces_id", "co_op", "co_op_code", "school_type", "source_file",
    "last_updated",
]

KPI_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c == "value" else T.StringType(), True)
    for c in KPI_COLUMNS
])

# Columns compared by value (the run timestamp is not).
KPI_VALUE_COLUMNS = [c for c in KPI_COLUMNS if c != "last_updated"]

# Identifier columns carried from the wide row unchanged.
ID_PASSTHROUGH = ["county_number", "county_name", "district_number", "school_code",
                  "state_school_id", "nces_id", "co_op", "co_op_code", "school_type"]

# Logical key used for dedupe and duplicate checks.
LOGICAL_KEY = ["district", "school_id", "school_name", "year", "student_group", "metric"]


def select_kpi_columns(df: DataFrame, with_timestamp: bool = False,
                       extra: list[str] | None = None) -> DataFrame:
    """Reorder to the KPI schema; columns the frame lacks become typed nulls."""
    cols = KPI_COLUMNS if with_timestamp else KPI_VALUE_COLUMNS
    present = set(df.columns)
    out: list[Column] = []
    for f in KPI_SCHEMA.fields:
        if f.name not in cols:
            continue
        c = F.col(f.name) if f.name in present else F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out, *(extra or []))
