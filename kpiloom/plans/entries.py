"""Metric entries that a source's job and its export share: both prepare the same
typed columns, the job from its fixture and the export from CSV."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions import derive as D
from kpiloom.operators.longform import Entry

# Metric names of the sources.
KINDERGARTEN_PARTS = {"ready_with_interventions": "rwi", "ready": "rdy", "ready_with_enrichments": "rwe"}
KINDERGARTEN_DEFAULTS = ["kindergarten_readiness_rate", "kindergarten_readiness_count", "kindergarten_readiness_total",
                         *(f"kindergarten_{p}_{k}" for p in KINDERGARTEN_PARTS for k in ("count", "rate"))]
ASSESSMENT = "kentucky_summative_assessment_"
ASSESSMENT_NAMES = ["novice_rate", "apprentice_rate", "proficient_rate", "distinguished_rate", "proficient_distinguished_rate", "content_index_score"]


def kindergarten_entries() -> list[Entry]:
    """Count format: three parts, shares of their sum, and the total ready; percent
    format: rate, number tested and the count they give.  By prior setting only
    on rows of all students.  Columns: count_format, prior_all, prior_slug,
    demo_all, rwi, rdy, rwe, tested, ready, pct, number_tested."""
    counts = F.col("count_format") & F.col("tested").isNotNull()
    everyone, prior = F.col("prior_all"), ~F.col("prior_all") & F.col("demo_all")
    percent = ~F.col("count_format")
    tested, ready, pct, number = F.col("tested"), F.col("ready"), F.col("pct"), F.col("number_tested")
    some, given, both = tested > 0, ready.isNotNull(), number.isNotNull() & pct.isNotNull()
    by_prior = lambda k: F.concat(F.lit("kindergarten_"), F.col("prior_slug"), F.lit(f"_{k}"))
    share, estimate = F.try_divide(ready, tested) * 100, D.count_from_rate(pct, number)
    entries = []
    for name, c in KINDERGARTEN_PARTS.items():
        entries.append(Entry(f"kindergarten_{name}_count", F.col(c), counts & everyone))
        entries.append(Entry(f"kindergarten_{name}_rate", F.try_divide(F.col(c), tested) * 100, counts & everyone & some))
    return [*entries,
            Entry("kindergarten_readiness_count", ready, counts & everyone & given),
            Entry("kindergarten_readiness_total", tested, counts & everyone & given),
            Entry("kindergarten_readiness_rate", share, counts & everyone & given & some),
            Entry(by_prior("count"), ready, counts & prior & given),
            Entry(by_prior("rate"), share, counts & prior & given & some),
            Entry("kindergarten_readiness_rate", pct, percent & everyone & pct.isNotNull()),
            Entry("kindergarten_readiness_total", number, percent & everyone & number.isNotNull()),
            Entry("kindergarten_readiness_count", estimate, percent & everyone & both),
            Entry(by_prior("rate"), pct, percent & prior & both),
            Entry(by_prior("count"), estimate, percent & prior & both)]


def kindergarten_defaults() -> list[Entry]:
    """``percent_file``: the file delivers the columns of the percent format."""
    none, prior = F.lit(None).cast("double"), F.col("percent_file") & ~F.col("prior_all") & F.col("demo_all")
    return [*(Entry(m, none, F.lit(True)) for m in KINDERGARTEN_DEFAULTS),
            *(Entry(F.concat(F.lit("kindergarten_"), F.col("prior_slug"), F.lit(f"_{k}")), none, prior) for k in ("count", "rate"))]


def _assessment_names(name: str) -> list[tuple[Column, Column]]:
    """(metric, condition): by the row's grade and by its level."""
    stem = F.concat(F.lit(ASSESSMENT), F.col("subject_n"), F.lit(f"_{name}_"))
    return [(F.concat(stem, "grade_n"), F.col("grade_n") != "all_grades"), (F.concat(stem, "level_n"), F.col("level_n") != "all")]


def assessment_entries() -> list[Entry]:
    return [Entry(metric, F.col(n), F.col(n).isNotNull() & named) for n in ASSESSMENT_NAMES for metric, named in _assessment_names(n)]


def assessment_defaults(content_index: Column | None = None) -> list[Entry]:
    """``content_index``: whether the row's file delivers it (default: yes)."""
    none = F.lit(None).cast("double")
    return [Entry(metric, none, named & content_index if n == "content_index_score" and content_index is not None else named)
            for n in ASSESSMENT_NAMES for metric, named in _assessment_names(n)]
