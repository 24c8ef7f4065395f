"""Column expressions for markers, numbers, bounds, years, ids and flags.

Every function maps Column -> Column (JVM expressions only), so a chain of them
collapses into the projection of the scan stage.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole-cell missing markers of the raw exports.
MISSING_MARKERS = ["*", "**", "", "N/A", "n/a", "---", "--", "<10", '""']
# Tokens a pandas CSV reader already reads as missing (default na_values).
READER_NULL_TOKENS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                      "n/a", "nan", "null"]
ALL_NULL_TOKENS = list(dict.fromkeys(MISSING_MARKERS + READER_NULL_TOKENS))

# Characters stripped before a text is read as a number.
NUMBER_NOISE = ',"%*'
# A plain decimal number; anything else (12d, 1_000, inf, NaN) is not a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Suppression flag spellings.
FLAG_YES = ["YES", "Y", "1", "TRUE"]

DEFAULT_YEAR = "2024"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


_MARKER_SQL = _sql_list(ALL_NULL_TOKENS)


def null_markers(c: Column | str, markers: list[str] | None = None) -> Column:
    """Whole-cell missing markers -> null (exact match, no trimming).

    Given a column name, the test is one parsed ``IN`` (optimised to a hash
    set) rather than one literal object per marker."""
    if isinstance(c, str) and markers is None:
        name = "`" + c.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {name} IN ({_MARKER_SQL}) THEN NULL ELSE {name} END")
    c = _c(c)
    return F.when(~c.isin(markers or ALL_NULL_TOKENS), c)


def parse_number(c: Column | str) -> Column:
    """Strip , " % * and surrounding blanks, then read a plain number; else null."""
    s = F.trim(reduce(lambda text, noise: F.replace(text, F.lit(noise), F.lit("")), NUMBER_NOISE, _c(c).cast("string")))
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def range_guard(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Keep values inside [lo, hi] (either bound optional); others -> null."""
    c = _c(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return F.when(cond, c)


def out_of_range(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """True when a non-null value is rejected by ``range_guard``."""
    c = _c(c)
    return c.isNotNull() & range_guard(c, lo, hi).isNull()


def year_from_school_year(c: Column | str, default: str = DEFAULT_YEAR) -> Column:
    """YYYYYYYY -> ending year, YYYY -> itself, anything else -> ``default``."""
    s = _c(c).cast("string")
    return (F.when(F.length(s) == 8, F.substring(s, 5, 4))
             .when(F.length(s) == 4, s)
             .otherwise(F.lit(default)))


def year_from_text_or_file(c: Column | str, file_name: Column | str) -> Column:
    """Last four characters of the school year, else the first 20xx in the file name."""
    s = F.trim(_c(c).cast("string"))
    from_file = F.regexp_extract(_c(file_name), r"(20\d{2})", 1)
    return F.when(F.length(s) >= 4, F.substring(s, -4, 4)).otherwise(F.nullif(from_file, F.lit("")))


def clean_school_id(c: Column | str) -> Column:
    """Trim, drop a float ``.0`` suffix, keep leading zeros; missing -> null."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"\.0$", "")
    return F.when(s != "", s)


def standardize_school_name(c: Column | str) -> Column:
    s = F.trim(_c(c))
    return (F.when(s.isNull(), F.lit("Unknown School"))
             .when(s == "All Schools", F.lit("---District Total---"))
             .otherwise(s))


def suppression_flag(c: Column | str) -> Column:
    """Yes/Y/1/true -> 'Y'; everything else (No/N/0/false/unknown/null) -> 'N'."""
    s = F.upper(F.trim(_c(c).cast("string")))
    return F.when(s.isin(FLAG_YES), F.lit("Y")).otherwise(F.lit("N"))


def infer_suppression(rate: Column | str, demographic: Column | str | None = None,
                      all_of: list[Column | str] | None = None) -> Column:
    """No flag column: 'Y' when the rate is null for a labelled row, or when
    every listed measure is null."""
    cond = F.lit(False)
    if demographic is not None:
        cond = cond | (_c(rate).isNull() & _c(demographic).isNotNull())
    else:
        cond = cond | _c(rate).isNull()
    if all_of:
        cond = cond | F.coalesce(*[_c(x) for x in all_of]).isNull()
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def override_suppression(flag: Column | str, data: list[Column | str]) -> Column:
    """A 'Y' flag on a row that does carry data is cleared to 'N'."""
    has_data = F.coalesce(*[_c(x).cast("string") for x in data]).isNotNull()
    return F.when((_c(flag) == "Y") & has_data, F.lit("N")).otherwise(_c(flag))


def slugify(c: Column | str) -> Column:
    """lower, trim, space / '-' -> '_', one '__' -> '_' pass, keep [a-z0-9_]."""
    s = F.trim(F.lower(_c(c)))
    s = F.regexp_replace(s, r"[ /\-]", "_")
    s = F.replace(s, F.lit("__"), F.lit("_"))
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_]", "")
    return F.when(_c(c).isNull(), F.lit("unknown")).otherwise(s)


def to_snake_case(name: str) -> str:
    """Header text -> snake_case column name (driver-side, names only); a word
    starts where a capital follows a small letter or digit, and at a capital
    before a small letter (``stateSchoolID`` -> ``state_school_id``)."""
    s = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z0-9])(?=[A-Z][a-z])", "_", name.strip())
    s = s.lower().replace("(", "").replace(")", "")
    s = s.replace(" ", "_").replace("-", "_")
    while "__" in s:
        s = s.replace("__", "_")
    return s
