"""Small configuration tables as JVM-side local relations.

``createDataFrame(list)`` plans as a scan of a Python RDD: every use ships
pickled rows through Python workers.  Configuration-sized tables (dimension
maps, expectation lists) are instead written as an inline ``VALUES`` relation,
which the planner sees as a ``LocalRelation`` with exact size statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Raw(str):
    """A SQL literal expression passed through unquoted (array(...), map(...))."""


def _lit(v) -> str:
    if isinstance(v, Raw):
        return str(v)
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def _split_fields(schema: str) -> list[str]:
    """Split 'a string, m map<string,string>' on top-level commas."""
    out, depth, cur = [], 0, []
    for ch in schema:
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    out.append("".join(cur))
    return [f for f in out if f.strip()]


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """rows + 'a string, b int' -> DataFrame backed by a LocalRelation."""
    fields = [f.strip().split(None, 1) for f in _split_fields(schema)]
    names = [f[0] for f in fields]
    types = [f[1] for f in fields]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields)
        return spark.sql(f"SELECT {cols} WHERE FALSE")
    values = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in zip(names, types))
    alias = ", ".join(f"`{n}`" for n in names)
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({alias})")
