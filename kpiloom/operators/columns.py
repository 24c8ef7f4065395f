"""Frame-level column operators: header dictionaries, snake_case, config casts,
config renames and constants.  All are single projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.clean import NUMBER_PATTERN, to_snake_case

# Canonical id columns and the header spellings seen in the exports
# (newest title case and historical upper case).
COMMON_HEADERS: dict[str, list[str]] = {
    "school_year": ["School Year", "SCHOOL YEAR"],
    "county_number": ["County Number", "COUNTY NUMBER"],
    "county_name": ["County Name", "COUNTY NAME"],
    "district_number": ["District Number", "DISTRICT NUMBER"],
    "district_name": ["District Name", "DISTRICT NAME"],
    "school_number": ["School Number", "SCHOOL NUMBER"],
    "school_name": ["School Name", "SCHOOL NAME"],
    "school_code": ["School Code", "SCHOOL CODE"],
    "state_school_id": ["State School Id", "STATE SCHOOL ID"],
    "nces_id": ["NCES ID"],
    "co_op": ["CO-OP"],
    "co_op_code": ["CO-OP Code", "CO-OP CODE"],
    "school_type": ["School Type", "SCHOOL TYPE"],
    "demographic": ["Demographic", "DEMOGRAPHIC"],
    "grade": ["Grade", "GRADE"],
    "suppressed": ["Suppressed", "SUPPRESSED"],
}

BOM = "﻿"


def header_dictionary(source: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Common dictionary overridden by the source dictionary (same canonical name)."""
    merged = {k: list(v) for k, v in COMMON_HEADERS.items()}
    for k, v in (source or {}).items():
        merged[k] = list(v)
    return merged


def rename_columns(df: DataFrame, source: dict[str, list[str]] | None = None) -> DataFrame:
    """Map year-specific headers to canonical names in one projection.

    Several raw headers may land on the same name (after a by-name union of
    files with different headers); they are coalesced.  Unknown columns pass.
    """
    mapping = header_dictionary(source)
    spelled: dict[str, str] = {}
    for canon, spellings in mapping.items():
        for s in spellings:
            spelled.setdefault(s, canon)
    for canon, spellings in (source or {}).items():  # a header that both name is the source's
        spelled.update(dict.fromkeys(spellings, canon))
    targets: dict[str, list[str]] = {}
    passthrough: list[str] = []
    for c in df.columns:
        clean = c.replace(BOM, "")
        canon = spelled.get(clean)
        if canon is None:
            passthrough.append(c)
        else:
            targets.setdefault(canon, []).append(c)
    cols = []
    for canon, raws in targets.items():
        src = [F.col(f"`{r}`") for r in raws]
        cols.append((F.coalesce(*src) if len(src) > 1 else src[0]).alias(canon))
    cols += [F.col(f"`{c}`") for c in passthrough if c not in targets]
    return df.select(*cols)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_snake_case(c.replace(BOM, "")) for c in df.columns])


_NUMERIC = ("float", "int", "Int64", "Int32", "Float64")


def cast_by_config(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """Configured dtypes: numeric targets read plain numbers (anything else ->
    null), integer targets keep only whole values; ``str`` casts to string.
    Columns not in the frame are ignored."""
    out = {}
    for c, dt in dtypes.items():
        if c not in df.columns:
            continue
        col = F.col(c)
        if dt.lower().startswith(("float", "int")) or dt in _NUMERIC:
            s = F.trim(col.cast("string"))
            num = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
            if dt.lower().startswith("int"):
                out[c] = F.when(num == F.floor(num), num.try_cast("bigint"))
            else:
                out[c] = num
        else:
            out[c] = col.cast("string")
    return df.withColumns(out) if out else df


def rename_by_config(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def derive_constants(df: DataFrame, derive: dict[str, str], source_name: str | None = None) -> DataFrame:
    cols = {k: F.lit(v) for k, v in derive.items()}
    if source_name is not None:
        cols["data_source"] = F.lit(source_name)
    return df.withColumns(cols)
