"""Declarative source specs: how a wide delivery becomes long KPI rows.

A spec names the typed-wide preparation (canonical measure columns and the
'Y'/'N' flag), the metric entries, the suppressed defaults and the emission
policy.  ``run_spec`` composes the shared steps around it; everything is one
narrow stage except the broadcast dimension joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.demographics import DemographicDims
from kpiloom.operators.longform import (AGGREGATE_LABELS, Entry, null_marker_strings, skip_aggregate_rows,
                                        wide_to_long, with_kpi_ids)
from kpiloom.schema import ID_PASSTHROUGH, KPI_SCHEMA, KPI_VALUE_COLUMNS

ID_TEMPLATE = ["year", "district", "school_id", "school_name", "student_group", "suppressed", "source_file", *ID_PASSTHROUGH]


class SpecError(ValueError):
    """A hook of a spec whose result lacks columns or has others of a wrong type."""


@dataclass
class SourceSpec:
    name: str
    prepare: Callable[[DataFrame], DataFrame]
    entries: Callable[[], list[Entry]]
    defaults: Callable[[], list[Entry | str]] = field(default=lambda: [])
    policy: str = "row"
    source_file: Callable[[], Column] = field(
        default=lambda: F.concat(F.lit("source_"), F.substring("school_year", 5, 4), F.lit(".csv")))
    skip_aggregates: bool = True
    # hooks: rows to leave out, given the default condition; id columns, given the typed frame and
    # the default template; KPI rows, given the frame with ids and the default conversion
    skip: Callable[[Column], Column] | None = None
    id_template: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame] | None = None
    convert: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame] | None = None


def checked(spec: SourceSpec, step: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``df``, if it has the KPI table's ``columns`` with their types."""
    given = {f.name: f.dataType for f in df.schema.fields}
    faults = [f"no column {c}" for c in columns if c not in given]
    faults += [f"{c} is {given[c].simpleString()}, not {KPI_SCHEMA[c].dataType.simpleString()}" for c in columns if c in given and given[c] != KPI_SCHEMA[c].dataType]
    faults += [f"more than one column {c}" for c in columns if df.columns.count(c) > 1]
    if faults:
        raise SpecError(f"{spec.name}, {step}: {'; '.join(faults)}")
    return df


def _kept(spec: SourceSpec, typed: DataFrame) -> DataFrame:
    if spec.skip is None:
        return skip_aggregate_rows(typed) if spec.skip_aggregates else typed
    default = (F.col("demographic").isNull() | F.col("demographic").isin(AGGREGATE_LABELS)) if spec.skip_aggregates else F.lit(False)
    condition = spec.skip(default)
    kind = typed.select(condition.alias("skip")).schema["skip"].dataType.simpleString()
    if kind != "boolean":
        raise SpecError(f"{spec.name}, skip: {kind}, not boolean")
    return typed.filter(~F.coalesce(condition, F.lit(False)))  # a row of which nothing is known stays


def run_spec(spec: SourceSpec, wide: DataFrame, dims: DemographicDims) -> DataFrame:
    typed = _kept(spec, spec.prepare(null_marker_strings(wide)))

    def template(df: DataFrame) -> DataFrame:
        return with_kpi_ids(df, dims, source_file=spec.source_file())

    def emit(df: DataFrame) -> DataFrame:
        return wide_to_long(df, spec.entries(), spec.policy, spec.defaults())

    ids = template(typed) if spec.id_template is None else checked(spec, "id template", spec.id_template(typed, template), ID_TEMPLATE)
    if spec.convert is None:
        return emit(ids)
    return checked(spec, "conversion", spec.convert(ids, emit), KPI_VALUE_COLUMNS).select(KPI_VALUE_COLUMNS)
