"""Deliveries of CSV files whose headers drift: every file's header resolved on
the executors, one scan for all of them, and no file counted by a part of its rows.

* ``inspect`` reads every file once, to its end, as lines: one aggregation gives
  its first line and number of lines.  The driver lists names and lengths and opens
  no file.  A file that fails Spark's task retries is left out whole, by itself,
  and the pass is run again without it; the table of deliveries says why.
* ``scan`` reads all other files with one positional schema, and joins each row to
  its file's header: column k of the result is the field at the place that the
  header gives it.  Neither the plan nor the number of scans grows with the
  number of headers.

The join is on the file's path and has no hint: AQE broadcasts the table of headers
if it is small, else sorts both sides and splits large files as skewed keys.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import materialized
from kpiloom.sources.local import local_table

log = logging.getLogger(__name__)

BOM = "﻿"
MAX_UNREADABLE = 100
# fields of a row over the widest header, so that too long rows keep their fields
SPARE_FIELDS = 16
LISTED = "path string, length long, status string, n_lines long, header array<string>, error string"


class UnreadableFiles(OSError):
    """Files that could not be read to their end, where the caller has no table that names them."""


@dataclass
class Deliveries:
    """``table``: a row a file, with status ok, empty (no line) or unreadable;
    ``names``: the column names of all headers, without case; ``width``: the longest header."""

    spark: SparkSession
    table: DataFrame
    paths: list[str]
    names: list[str]
    width: int
    unreadable: dict[str, str]


def list_files(spark: SparkSession, pattern: str, allow: list[str] | None = None) -> list[tuple[str, int]]:
    """(path, length) of the files that match ``pattern`` (a Hadoop glob) and, by
    path or name, one of the ``allow`` globs: metadata only."""
    jvm = spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.Path(pattern)
    out = []
    for st in glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or []:
        path, name = st.getPath().toString(), st.getPath().getName()
        if st.isDirectory() or name.startswith(("_", ".")):
            continue
        if allow is None or any(fnmatch.fnmatch(path, a) or fnmatch.fnmatch(name, a) for a in allow):
            out.append((path, st.getLen()))
    return out


def unique_names(header: list[str]) -> list[str]:
    """Header names with repeats numbered: a, b, a -> a, b, a_2 (names compare
    without case, as Spark's columns do)."""
    out, seen = [], set()
    for name in header:
        new, i = name, 1
        while new.lower() in seen:
            i += 1
            new = f"{name}_{i}"
        seen.add(new.lower())
        out.append(new)
    return out


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, n_lines, line): every file read to its end.  Files are told by a
    hash of their path; each task hands on one row a batch and file, with the line only
    where a file begins, so lines are neither sorted nor shuffled."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])][:len(file)])
            begins = [(file[i], block[i]) != last if k == 0 else True for k, i in enumerate(at)]
            lines = [batch.column(2)[int(i)].as_py() if new and block[i] == 0 else None for i, new in zip(at, begins)]
            yield pa.RecordBatch.from_arrays([pa.array(file[at], pa.int64()), pa.array(np.diff(np.r_[at, len(file)]), pa.int64()), pa.array(lines, pa.string())],
                                             ["file", "n_lines", "line"])
            last = (file[-1], block[-1]) if len(file) else last

    lines = spark.read.option("ignoreCorruptFiles", False).text(paths)
    counted = (lines.select(F.xxhash64(_key("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
               .mapInArrow(runs, "file long, n_lines long, line string"))
    return counted.groupBy("file").agg(F.sum("n_lines").alias("n_lines"), F.max("line").alias("line"))


def _culprit(error: Exception, paths: list[str]) -> str | None:
    """The file that a failed read names."""
    said = " ".join(re.findall(r"FAILED_READ_FILE.*", str(error))) or str(error)
    found = [p for p in paths if re.search(re.escape(re.sub(r"^file:/+", "", p)) + r"(?![\w/-]|\.\w)", said)]
    return max(found, key=len) if found else None


def inspect(spark: SparkSession, files: list[tuple[str, int]]) -> Deliveries:
    """Read every file to its end; those that can't be are left out whole and listed."""
    length = dict(files)
    left, unreadable = [p for p, n in files if n], {}
    lines = None
    while left:
        try:
            lines = materialized(_first_lines(spark, left), "deliveries")
            break
        except (PySparkException, Py4JJavaError) as e:
            path = _culprit(e, left)
            if path is None or len(unreadable) >= MAX_UNREADABLE:
                raise
            log.warning("left out, could not be read to its end: %s", path)
            unreadable[path] = next(iter(re.findall(r"Caused by: (.*)", str(e))[-1:] or str(e).splitlines()))[:300]
            left.remove(path)

    @F.pandas_udf("array<string>")
    def fields(headers: pd.Series) -> pd.Series:
        return pd.Series([unique_names(next(csv.reader(io.StringIO(h.lstrip(BOM))), [])) for h in headers])

    silent = [(p, n, "unreadable" if p in unreadable else "empty", None, None, unreadable.get(p)) for p, n in files if not n or p in unreadable]
    table = local_table(spark, silent, LISTED)
    if lines is None:
        return Deliveries(spark, table, [], [], 0, unreadable)
    headers = materialized(lines.select("line").distinct().withColumn("header", fields("line")), "headers")  # a row a header, not a file
    spelled = headers.select(F.explode("header").alias("name")).groupBy(F.lower("name").alias("key")).agg(F.min("name").alias("name"))
    names = sorted(r["name"] for r in spelled.collect())  # the columns of the result; names compare without case
    width = headers.agg(F.max(F.size("header"))).first()[0] or 0
    sizes = local_table(spark, [(p, _plain(p), length[p]) for p in left], "path string, plain string, length long")
    read = (lines.join(sizes.withColumn("file", F.xxhash64("plain")), "file").join(headers, "line")
            .select("path", "length", F.lit("ok").alias("status"), "n_lines", "header", F.lit(None).cast("string").alias("error")))
    return Deliveries(spark, materialized(read.unionByName(table), "delivery-table"), left, names, width, unreadable)


def _plain(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _key(path: str) -> Column:
    """The path that a scan gives (a URI, escaped) as a listing spells it (``_plain``).
    Rows of a path without an escape, which is most, are spared the decoding."""
    plain = F.regexp_replace(path, "^file:/+", "/")
    return F.when(F.contains(F.col(path), F.lit("%")), F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))).otherwise(plain)


def scan(found: Deliveries, multi_line: bool = False) -> DataFrame:
    """The rows of all readable files as string columns by header name, plus
    ``_source_path``, ``_source_header`` and ``_corrupt`` (the raw line where the
    number of fields is not the header's)."""
    spark = found.spark
    if not found.paths:
        return spark.sql("SELECT CAST(NULL AS STRING) AS _source_path, CAST(NULL AS ARRAY<STRING>) AS _source_header, "
                         "CAST(NULL AS STRING) AS _corrupt WHERE FALSE")
    places = [f"_{i}" for i in range(found.width + SPARE_FIELDS)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*places, "_raw"]])
    rows = (spark.read.schema(schema)
            .option("header", True).option("quote", '"').option("escape", '"').option("enforceSchema", True)
            .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
            .option("columnNameOfCorruptRecord", "_raw").option("ignoreCorruptFiles", False)
            .csv(found.paths)
            .withColumns({"_path": F.col("_metadata.file_path"), "_key": _key("_metadata.file_path")}))
    lower = F.transform("header", F.lower)
    at = F.array(*(F.array_position(lower, F.lower(F.lit(n))).cast("int") - 1 for n in found.names))
    headers = found.table.filter("status = 'ok'").select(F.regexp_replace("path", "^file:/+", "/").alias("_key"), F.col("header").alias("_header"), at.alias("_at"))
    bare = F.regexp_replace("_raw", '"[^"]*"', "")
    n_fields = F.when(F.col("_raw").isNull(), len(places)).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1)
    # no header reaches beyond the widest; without the spare fields the parser is told which fields it has
    # to give, and no row of fewer fields than the schema costs it an exception.  The slice keeps the
    # optimizer from putting the array of all fields again in the place of every column
    fields = F.slice(F.array(*places[:found.width]), 1, found.width)
    corrupt = F.when(n_fields != F.size("_header"), F.coalesce("_raw", F.concat_ws(",", F.array(*places))))
    return rows.withColumn("_fields", fields).join(headers, "_key").select(
        *(F.get("_fields", F.get("_at", F.lit(k))).alias(n) for k, n in enumerate(found.names)), corrupt.alias("_corrupt"),
        F.col("_path").alias("_source_path"), F.col("_header").alias("_source_header"))
