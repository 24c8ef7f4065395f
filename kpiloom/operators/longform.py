"""Wide -> long KPI conversion as one narrow stage.

Each wide row carries one ``struct<metric, value, suppressed>`` column per candidate
of its extracted entries under one of the emission policies, null where it emits
none; an unpivot then emits the KPI rows.  No per-row Python, no union of one select
per metric (which would scan the input once per metric).

Policies
  row     suppressed row -> its extracted metrics (or the defaults when none)
          with null values and 'Y'; other rows -> extracted metrics with a value.
          A "positive only" source is the row policy with ``keep = value > 0``.
  metric  every extracted metric; a null or negative value -> null and 'Y'.
  always  every entry, value null when the row is suppressed; flag from the row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.clean import (clean_school_id, null_markers, standardize_school_name,
                                     year_from_school_year)
from kpiloom.operators.demographics import DemographicDims, map_demographic
from kpiloom.schema import ID_PASSTHROUGH, KPI_COLUMNS, select_kpi_columns

# Demographic labels of aggregate rows that are not groups.
AGGREGATE_LABELS = ["Total Events", "---District Total---", "District Total", "All Schools"]


@dataclass
class Entry:
    """One candidate metric of a wide row."""
    metric: str | Column
    value: Column
    keep: Column | None = None      # extraction condition; default: value is not null


@dataclass
class Candidates:
    """The candidate rows of a wide row, null where not kept: its entries, or the
    defaults in their place where ``fall_back``."""
    entries: list[Column]
    defaults: list[Column]
    fall_back: Column


def _cand(metric: Column, value: Column, flag: Column, keep: Column) -> Column:
    row = F.struct(metric.cast("string").alias("metric"), value.cast("double").alias("value"),
                   flag.cast("string").alias("suppressed"))
    return F.when(F.coalesce(keep, F.lit(False)), row)


def entries_column(entries: list[Entry], policy: str = "row", flag: Column | str = "suppressed",
                   defaults: list[Entry] | None = None) -> Candidates:
    """Per-row candidate (metric, value, suppressed) structs.

    Every decision is a plain column expression on the row (no higher-order
    functions), so they are compiled.  Whether the defaults apply depends on all
    entries and is left to one column, not repeated in every candidate."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    supp = F.coalesce(flag == "Y", F.lit(False))
    null_d = F.lit(None).cast("double")

    def name(e: Entry) -> Column:
        return F.lit(e.metric) if isinstance(e.metric, str) else e.metric

    def extracted(e: Entry) -> Column:
        v = e.value.cast("double")
        return F.coalesce(e.keep if e.keep is not None else v.isNotNull(), F.lit(False))

    has_any = F.lit(False)
    for e in entries:
        has_any = has_any | extracted(e)
    out: list[Column] = []
    if policy == "row":
        for e in entries:
            v = e.value.cast("double")
            out.append(_cand(name(e), F.when(~supp, v), F.when(supp, F.lit("Y")).otherwise(F.lit("N")),
                             extracted(e) & (supp | v.isNotNull())))
    elif policy == "metric":
        for e in entries:
            v = e.value.cast("double")
            ok = F.coalesce(v >= 0, F.lit(False))
            out.append(_cand(name(e), F.when(ok, v), F.when(ok, F.lit("N")).otherwise(F.lit("Y")), extracted(e)))
    elif policy == "always":
        for e in entries:
            v = e.value.cast("double")
            out.append(_cand(name(e), F.when(~supp, v), F.when(supp, F.lit("Y")).otherwise(F.lit("N")), F.lit(True)))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    instead = [] if policy == "always" else [_cand(name(d), null_d, F.lit("Y"), extracted(d)) for d in defaults or []]
    return Candidates(out, instead, supp & ~has_any)


def explode_entries(df: DataFrame, candidates: Candidates, keep_cols: list[str]) -> DataFrame:
    """Carry ``keep_cols`` and emit one row per kept candidate (metric, value, suppressed).

    No entry is kept where the defaults apply, so both share columns."""
    base = [c for c in keep_cols if c not in ("metric", "value", "suppressed")]
    rows = candidates.entries
    if candidates.defaults:
        df = df.withColumn("_fall_back", candidates.fall_back)
        none = F.lit(None)
        rows = [F.when(F.col("_fall_back"), d).otherwise(e) for e, d in zip_longest(rows, candidates.defaults, fillvalue=none)]
    names = [f"_row_{i}" for i in range(len(rows))]
    long = df.select(*base, *[r.alias(n) for n, r in zip(names, rows)]).unpivot(base, names, "_which", "_row")
    return long.filter(F.col("_row").isNotNull()).select(*base, "_row.*")


def skip_aggregate_rows(df: DataFrame, label: str = "demographic") -> DataFrame:
    """Drop rows without a demographic label or with an aggregate label."""
    c = F.col(label)
    return df.filter(c.isNotNull() & ~c.isin(AGGREGATE_LABELS))


def with_kpi_ids(df: DataFrame, dims: DemographicDims, source_file: Column,
                 flag: Column | None = None, year: Column | None = None,
                 default_year: str = "2024") -> DataFrame:
    """Add the KPI id template: year, district, school_id, school_name,
    student_group (+ mapping_type), suppressed, source_file, passthrough ids."""
    cols = set(df.columns)

    def col_or(name: str, default: Column) -> Column:
        return F.col(name) if name in cols else default

    null_s = F.lit(None).cast("string")
    yr = year if year is not None else (
        year_from_school_year(F.col("school_year"), default_year) if "school_year" in cols else F.lit(default_year))
    add = {
        "year": yr,
        "district": col_or("district_name", F.lit("Unknown District")),
        "school_id": clean_school_id(col_or("school_code", null_s)),
        "school_name": standardize_school_name(col_or("school_name", null_s)),
        "suppressed": flag if flag is not None else col_or("suppressed", F.lit("N")),
        "source_file": source_file,
    }
    for c in ID_PASSTHROUGH:
        if c not in cols:
            add[c] = null_s
    out = df.withColumns(add)
    if "demographic" not in out.columns:
        out = out.withColumn("demographic", null_s)
    return map_demographic(out, dims)


def wide_to_long(df: DataFrame, entries: list[Entry], policy: str = "row",
                 defaults: list[Entry] | list[str] | None = None,
                 extra: list[str] | None = None) -> DataFrame:
    """Rows carrying the KPI id template -> long KPI rows (schema order).

    Rows without a school id are quarantined (left out); use ``quarantine_rows``
    to see them.
    """
    dflt = [d if isinstance(d, Entry) else Entry(d, F.lit(None).cast("double"), F.lit(True))
            for d in (defaults or [])]
    candidates = entries_column(entries, policy, "suppressed", dflt)
    good = df.filter(F.col("school_id").isNotNull())
    keep = [c for c in df.columns if c in KPI_COLUMNS or c in (extra or [])]
    long = explode_entries(good, candidates, keep)
    return select_kpi_columns(long, extra=extra)


def null_marker_strings(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Apply ``null_markers`` to every string column (one projection)."""
    ex = set(exclude or [])
    return df.select(*[null_markers(f.name).alias(f.name)
                       if f.dataType.simpleString() == "string" and f.name not in ex else F.col(f.name)
                       for f in df.schema.fields])


def quarantine_rows(df: DataFrame, reason_cols: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split on validity: (good rows, rejected rows with a ``reject_reason``)."""
    reason = None
    for name, bad in reason_cols.items():
        reason = F.when(bad, F.lit(name)) if reason is None else reason.when(bad, F.lit(name))
    tagged = df.withColumn("reject_reason", reason)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))
