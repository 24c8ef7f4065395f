"""Grade, level and subject labels as literal-map lookups (no joins, no UDFs)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named grade spellings.
GRADE_NAMES = {
    "All Grades": "all_grades", "ALL GRADES": "all_grades",
    "Kindergarten": "kindergarten", "Pre-K": "pre_k", "Preschool": "preschool",
}
# School level spellings (English learner and assessment share them).
LEVEL_NAMES = {
    "ES": "elementary", "Elementary School": "elementary", "Elementary": "elementary",
    "MS": "middle", "Middle School": "middle", "Middle": "middle",
    "HS": "high", "High School": "high", "High": "high",
    "All": "all",
}
# Subject codes and spellings.
SUBJECT_NAMES = {
    "MA": "math", "Mathematics": "math",
    "RD": "reading", "Reading": "reading",
    "SC": "science", "Science": "science",
    "SS": "social_studies", "Social Studies": "social_studies",
    "WR": "writing", "Writing": "writing",
}
ELEMENTARY_NAMED = ["kindergarten", "pre_k", "preschool"]


def _lit_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def normalize_grade(c: Column | str) -> Column:
    """'03' -> grade_3, 'Grade 7' -> grade_7, 'All Grades' -> all_grades,
    'Pre-K' -> pre_k, other text -> lower with '_'; null/blank -> all_grades."""
    c = F.col(c) if isinstance(c, str) else c
    g = F.trim(c)
    lowered = F.regexp_replace(F.lower(g), " ", "_")
    return (F.when(g.isNull() | (g == ""), F.lit("all_grades"))
             .when(g.rlike(r"^[0-9]+$"), F.concat(F.lit("grade_"), g.try_cast("int").cast("string")))
             .otherwise(F.coalesce(_lit_map(GRADE_NAMES)[g], lowered)))


def normalize_level(c: Column | str, unknown: str | None = "all") -> Column:
    """ES/MS/HS and spellings -> elementary/middle/high; blank -> all.
    Unknown text -> ``unknown`` (English learner) or, when None, its slug (assessment)."""
    c = F.col(c) if isinstance(c, str) else c
    v = F.trim(c)
    fallback = F.lit(unknown) if unknown is not None else F.regexp_replace(F.lower(v), " ", "_")
    return (F.when(v.isNull() | (v == ""), F.lit("all"))
             .otherwise(F.coalesce(_lit_map(LEVEL_NAMES)[v], fallback)))


def normalize_subject(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    v = F.trim(c)
    return (F.when(v.isNull() | (v == ""), F.lit("unknown_subject"))
             .otherwise(F.coalesce(_lit_map(SUBJECT_NAMES)[v], F.regexp_replace(F.lower(v), " ", "_"))))


def grade_to_level(grade: Column | str) -> Column:
    """Normalised grade -> school level: >= 9 high, >= 6 middle, else elementary."""
    g = F.col(grade) if isinstance(grade, str) else grade
    num = F.when(g.startswith("grade_") & F.split_part(g, F.lit("_"), F.lit(2)).rlike(r"^[0-9]+$"),
                 F.split_part(g, F.lit("_"), F.lit(2)).try_cast("int"))
    return (F.when(num >= 9, F.lit("high"))
             .when(num >= 6, F.lit("middle"))
             .when(num.isNotNull(), F.lit("elementary"))
             .when(g.isin(ELEMENTARY_NAMED), F.lit("elementary"))
             .otherwise(F.lit("all")))
