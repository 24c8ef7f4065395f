"""Demographic dimension: label mapping with an audit column, coverage by year.

The dimension is configuration (a few hundred labels at most); its tables are
built on the driver with known sizes and joined with ``broadcast`` hints behind
that size check, so the fact table is never shuffled for mapping.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.broadcast import DIMENSION_MAX_ROWS, sized_broadcast
from kpiloom.sources.local import Raw, _lit, local_table

ALL_STUDENTS = "All Students"
YEAR_SEP = "\u0001"

# Mapping types written to the audit column, in precedence order.
MAPPING_TYPES = ["default", "standard", "year_specific", "general", "case_insensitive", "no_mapping"]


@dataclass
class DemographicDims:
    standard: list[str]
    general_map: list[tuple[str, str]]                     # (label, mapped) in file order
    year_map: list[tuple[str, str, str]] = field(default_factory=list)  # (year, label, mapped)
    expected: list[tuple[str, str]] = field(default_factory=list)       # (year, label)
    required: list[str] = field(default_factory=list)
    allow_missing: list[str] = field(default_factory=list)
    years: list[str] = field(default_factory=list)                      # configured years

    # -- driver-side config tables (sizes known, keys made unique) ----------
    def standard_rows(self) -> list[tuple[str]]:
        return [(x,) for x in dict.fromkeys(self.standard)]

    def year_rows(self) -> list[tuple[str, str, str]]:
        d: dict[tuple[str, str], str] = {}
        for y, lab, m in self.year_map:
            d[(y, lab)] = m
        return [(y, lab, m) for (y, lab), m in d.items()]

    def general_rows(self) -> list[tuple[str, str]]:
        d: dict[str, str] = {}
        for lab, m in self.general_map:
            d[lab] = m
        return list(d.items())

    def case_insensitive_rows(self) -> list[tuple[str, str]]:
        d: dict[str, str] = {}
        for lab, m in self.general_rows():          # first entry in file order wins
            d.setdefault(lab.lower(), m)
        return list(d.items())

    def required_rows(self) -> list[tuple[str, str]]:
        return [(y, lab) for y in self.years for lab in dict.fromkeys(self.required)]

    def rule_rows(self) -> list[tuple]:
        """One row per lower-cased label with every rule that can fire for it:
        (lkey, standard spellings, year map, exact general map, case-insensitive target)."""
        keys: dict[str, dict] = {}

        def slot(label: str) -> dict:
            return keys.setdefault(label.lower(), {"std": [], "year": {}, "gen": {}, "ci": None})

        for (lab,) in self.standard_rows():
            slot(lab)["std"].append(lab)
        for y, lab, m in self.year_rows():
            slot(lab)["year"][f"{y}{YEAR_SEP}{lab}"] = m
        for lab, m in self.general_rows():
            slot(lab)["gen"][lab] = m
        for lk, m in self.case_insensitive_rows():
            slot(lk)["ci"] = m

        def arr(xs):
            return Raw("array(" + ", ".join(_lit(x) for x in xs) + ")")

        def mp(d):
            return Raw("map(" + ", ".join(f"{_lit(k)}, {_lit(v)}" for k, v in d.items()) + ")")

        return [(k, arr(v["std"]), mp(v["year"]), mp(v["gen"]), v["ci"]) for k, v in keys.items()]

    def rules_df(self, spark):
        rows = self.rule_rows()
        return self._frame(spark, rows, "_dm_key string, _dm_std array<string>, _dm_year map<string,string>, "
                                        "_dm_gen map<string,string>, _dm_ci string")

    def _frame(self, spark: SparkSession, rows: list, schema: str) -> DataFrame:
        df = local_table(spark, rows, schema)
        return sized_broadcast(df, DIMENSION_MAX_ROWS, known_rows=len(rows))

    def expected_df(self, spark):
        return self._frame(spark, [tuple(x) for x in dict.fromkeys(self.expected)], "year string, student_group string")

    def required_df(self, spark):
        return self._frame(spark, self.required_rows(), "year string, student_group string")

    def allow_missing_df(self, spark):
        return self._frame(spark, [(x,) for x in dict.fromkeys(self.allow_missing)], "student_group string")


def map_demographic(df: DataFrame, dims: DemographicDims, label: str = "demographic",
                    year: str = "year", out: str = "student_group",
                    type_col: str | None = "mapping_type") -> DataFrame:
    """Precedence: null/empty -> All Students; trimmed standard label; year map;
    general map; case-insensitive general map (first in file order); unchanged.

    One broadcast left join on lower(trim(label)): the rule row for that key
    carries the standard spellings and small exact-match maps, so the
    case-sensitive rules are map lookups on the joined row."""
    spark = df.sparkSession
    raw = F.col(label)
    lab = F.trim(raw)
    d = df.join(dims.rules_df(spark), F.lower(lab) == F.col("_dm_key"), "left")
    std = F.coalesce(F.array_contains(F.col("_dm_std"), lab), F.lit(False))
    yr = F.col("_dm_year")[F.concat(F.col(year).cast("string"), F.lit(YEAR_SEP), lab)]
    gen = F.col("_dm_gen")[lab]
    ci = F.col("_dm_ci")
    empty = raw.isNull() | (raw == "")
    mapped = (F.when(empty, F.lit(ALL_STUDENTS)).when(std, lab).when(yr.isNotNull(), yr)
               .when(gen.isNotNull(), gen).when(ci.isNotNull(), ci).otherwise(lab))
    kind = (F.when(empty, F.lit("default")).when(std, F.lit("standard"))
             .when(yr.isNotNull(), F.lit("year_specific")).when(gen.isNotNull(), F.lit("general"))
             .when(ci.isNotNull(), F.lit("case_insensitive")).otherwise(F.lit("no_mapping")))
    cols = {out: mapped}
    if type_col:
        cols[type_col] = kind
    d = d.withColumns(cols)
    return d.drop(*[c for c in d.columns if c.startswith("_dm_")])


def mapping_audit(mapped: DataFrame, type_col: str = "mapping_type",
                  file_col: str = "source_file") -> DataFrame:
    """Rows per mapping type and file: (mapping_type, source_file, n_rows)."""
    return mapped.groupBy(type_col, file_col).agg(F.count(F.lit(1)).alias("n_rows"))


def unmapped_labels(mapped: DataFrame, label: str = "demographic", year: str = "year",
                    type_col: str = "mapping_type") -> DataFrame:
    """Labels that fell through every rule, with their row counts per year."""
    return (mapped.filter(F.col(type_col) == "no_mapping")
                  .groupBy(F.trim(F.col(label)).alias("label"), F.col(year).alias("year"))
                  .agg(F.count(F.lit(1)).alias("n_rows")))


def demographic_coverage(kpi: DataFrame, dims: DemographicDims, year: str = "year",
                         group: str = "student_group") -> DataFrame:
    """One row per (year, status, group) for every year present in ``kpi``;
    status in valid / missing_required / missing_optional / unexpected, with
    the per-year totals of expected and actual groups."""
    spark = kpi.sparkSession
    key = ["year", "student_group"]
    actual = kpi.select(F.col(year).alias("year"), F.col(group).alias("student_group")).distinct()
    years = actual.groupBy("year").agg(F.count(F.lit(1)).alias("total_actual"))
    # the configured side: one row per (year, group) that says how the group counts
    allow = dims.allow_missing_df(spark).withColumn("_allowed", F.lit(True))
    config = (dims.expected_df(spark).withColumns({"_exp": F.lit(1), "_req": F.lit(0)})
              .unionByName(dims.required_df(spark).withColumns({"_exp": F.lit(0), "_req": F.lit(1)}))
              .groupBy(*key).agg(F.max("_exp").alias("_exp"), F.max("_req").alias("_req"))
              .join(allow, "student_group", "left"))
    # one full outer join of actual and configured groups decides every status
    both = actual.withColumn("_act", F.lit(True)).join(config, key, "full_outer")
    exp, missing = F.coalesce("_exp", F.lit(0)) == 1, F.col("_act").isNull() & F.col("_allowed").isNull()
    statuses = F.array(F.when(F.col("_act") & exp, F.lit("valid")), F.when(F.col("_act") & ~exp, F.lit("unexpected")),
                       F.when(missing & exp, F.lit("missing_optional")), F.when(missing & (F.col("_req") == 1), F.lit("missing_required")))
    status = both.select(*key, F.explode(F.array_compact(statuses)).alias("status"))
    totals = years.join(dims.expected_df(spark).groupBy("year").agg(F.count(F.lit(1)).alias("_n")), "year", "left") \
                  .select("year", "total_actual", F.coalesce("_n", F.lit(0)).cast("bigint").alias("total_expected"))
    return status.join(totals, "year").select("year", "status", "student_group",
                                              "total_expected", "total_actual")


def mapping_report(mapped: DataFrame, coverage: DataFrame, file_col: str = "source_file",
                   type_col: str = "mapping_type") -> DataFrame:
    """The report as one table: (section, year, item, n)."""
    files = (mapped.groupBy(F.col(file_col).alias("item")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit("files").alias("section"), F.lit(None).cast("string").alias("year"), "item", "n"))
    kinds = (mapped.groupBy(F.col(type_col).alias("item")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit("mapping_types").alias("section"), F.lit(None).cast("string").alias("year"), "item", "n"))
    cov = (coverage.groupBy("year", F.col("status").alias("item")).agg(F.count(F.lit(1)).alias("n"))
           .select(F.lit("coverage").alias("section"), "year", "item", "n"))
    return files.unionByName(kinds).unionByName(cov)
