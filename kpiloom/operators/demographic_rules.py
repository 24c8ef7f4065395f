"""The demographic dimension as a versioned table of rules.

A rule is a row: what it is called in the audit (``kind``), the label, what it maps
to, the years it holds in (null: no bound), whether the label counts without case,
and its precedence, then its place in the file.  A version of the table is a
folder; readers take the newest, or the newest up to one they name.

``map_by_rules`` is an as-of join: of the rules of a row's label that hold in its
year, the one of least precedence counts.  The rules of a label, whatever its case,
become one sorted array, so rows meet them in one join on the lower-cased
label, and the best rule is the first element that holds: facts are neither
multiplied nor grouped.  The join has no hint; the stored table's size lets the
planner broadcast it, and a dimension too large for that is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.demographics import ALL_STUDENTS
from kpiloom.sources.local import local_table

RULE_SCHEMA = "kind string, label string, mapped string, any_case boolean, valid_from int, valid_to int, precedence int, place int"


def rule_rows(standard: list[str], general: list[tuple[str, str]], by_year: list[tuple[int, int, str, str]]) -> list[tuple]:
    """Rules of the usual precedence: standard labels, spellings of a year, of any year, and these again without case."""
    rows = [("standard", label, label, False, None, None, 1) for label in standard]
    rows += [("year_specific", label, mapped, False, first, last, 2) for first, last, label, mapped in by_year]
    rows += [("general", label, mapped, False, None, None, 3) for label, mapped in general]
    rows += [("case_insensitive", label, mapped, True, None, None, 4) for label, mapped in general]
    return [(*row, place) for place, row in enumerate(rows)]


def _versions(spark: SparkSession, path: str) -> list[int]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def write_rules(spark: SparkSession, rows: list[tuple], path: str) -> int:
    """Store a new version of the rules; its number."""
    version = max(_versions(spark, path), default=0) + 1
    local_table(spark, rows, RULE_SCHEMA).coalesce(1).write.parquet(f"{path}/version={version}")
    return version


def read_rules(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """The newest version of the rules, or the newest up to the one named."""
    known = [v for v in _versions(spark, path) if up_to is None or v <= up_to]
    if not known:
        raise FileNotFoundError(f"no version of the rules {'' if up_to is None else f'up to {up_to} '}in {path}")
    return spark.read.schema(RULE_SCHEMA).parquet(f"{path}/version={known[-1]}")


def map_by_rules(df: DataFrame, rules: DataFrame, label: str = "demographic", year: str = "year",
                 out: str = "student_group", type_col: str = "mapping_type") -> DataFrame:
    """``df`` with the mapped label and the kind of the rule that gave it: null and
    empty labels are ``default``, those without a rule stay as they are (trimmed)."""
    rule = F.struct("precedence", "place", "label", "any_case", "valid_from", "valid_to", "mapped", "kind")
    by_key = rules.groupBy(F.lower("label").alias("_rule_key")).agg(F.sort_array(F.collect_list(rule)).alias("_rules"))
    raw, trimmed, of_year = F.col(label), F.trim(F.col(label)), F.col(year).try_cast("int")

    def holds(r: Column) -> Column:
        since = r["valid_from"].isNull() | F.coalesce(of_year >= r["valid_from"], F.lit(False))
        until = r["valid_to"].isNull() | F.coalesce(of_year <= r["valid_to"], F.lit(False))
        return since & until & (r["any_case"] | (r["label"] == trimmed))

    best = F.get(F.filter("_rules", holds), F.lit(0))
    empty = raw.isNull() | (raw == "")
    joined = df.join(by_key, F.lower(trimmed) == F.col("_rule_key"), "left").withColumn("_best", best)
    mapped = F.when(empty, F.lit(ALL_STUDENTS)).otherwise(F.coalesce(F.col("_best")["mapped"], trimmed))
    kind = F.when(empty, F.lit("default")).otherwise(F.coalesce(F.col("_best")["kind"], F.lit("no_mapping")))
    return joined.withColumns({out: mapped, type_col: kind}).drop("_rule_key", "_rules", "_best")
