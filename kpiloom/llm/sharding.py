"""Proportional stratified interleaving: every shard gets the same mixture of sources.

1. Rows are shuffled within their source by a seeded hash and numbered in that
   order.  The numbering is exact without putting a source into one task: the
   top bits of the hash deal a source into buckets, counts per (source,
   bucket) give each bucket its first rank, and a window numbers the rows of
   one bucket.  Rows that agree in all they are ordered by are counted first
   (map-side) and ranked as one entry with a weight.  An entry is unfolded
   into its rows again after the ranking; one of more than ``BLOCK`` rows goes
   through a shuffle as blocks first, so its rows are made by many tasks.
2. A row of rank r among n stands at the fraction (r + phase) / n of its
   source; the phase, a seeded hash of the source, keeps sources with few rows
   from meeting at the same fraction.
3. All rows are put in order of that fraction, again by buckets (of the
   fraction) with offsets, and the order is cut into shards whose row counts
   differ by one at most.  So each shard holds the mixture of the whole, up to
   a row or two a source.

Law: ``rows``.  Only ids, sizes and hashes are shuffled, never texts.  The
narrow rows are written once to the shared checkpoint folder, so that an
assignment is stable however often its parts are read again.

Cases: a null text has size 16 and a null checksum; a null source is a source
of its own; rows with a null or repeated id are rows like any other, and
wholly equal rows each get a slot of their own; texts of any length count by
their bytes only; other columns of the input are ignored; an empty table gives
an empty result.  Fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import table, written

SHARDS = 40
SEED = 20240607
ROW_OVERHEAD = 16
BUCKET_ROWS = 65_536
BLOCK = 65_536
LEAST_BUCKET_BITS = 8
_KEY = ["stratum", "bucket"]
_ORDER = ["h", "doc_id", "text_crc32", "size"]


def _bucket_bits(rows: int) -> int:
    return max(LEAST_BUCKET_BITS, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)) if rows > BUCKET_ROWS else 0)


def unfolded(entries: DataFrame, block: int) -> DataFrame:
    """Every entry ``weight`` times, numbered by ``copy`` from 0."""
    span = lambda first, last: F.explode(F.sequence(first, last))
    zero = F.lit(0).cast("long")
    light = entries.filter(F.col("weight") <= block).withColumn("copy", span(zero, F.col("weight") - 1))
    heavy = (entries.filter(F.col("weight") > block)
             .withColumn("_block", span(zero, F.expr(f"(weight - 1) div {block}")))
             .repartition("stratum", *_ORDER, "_block")
             .withColumn("copy", span(F.col("_block") * block, F.least(F.col("weight"), (F.col("_block") + 1) * block) - 1)))
    return light.unionByName(heavy.drop("_block"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, doc_id: str = "doc_id",
               text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot of every row of ``docs``."""
    text_bytes = F.col(text).cast("string").cast("binary")
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.when(F.col(source).isNotNull(), F.concat(F.lit("="), F.col(source).cast("string"))).otherwise("").alias("stratum"),
        (F.coalesce(F.octet_length(text_bytes), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text_bytes).alias("text_crc32"),
    ).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    rows = written(narrow.groupBy("stratum", *_ORDER).agg(F.count("*").alias("weight")), "shard-rows")
    total = rows.agg(F.sum("weight")).first()[0] or 0
    bits = _bucket_bits(total)
    rows = rows.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))

    in_source = Window.partitionBy("stratum")
    offsets = (rows.groupBy(*_KEY).agg(F.sum("weight").alias("n"))
               .select(*_KEY, (F.sum("n").over(in_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
                       F.sum("n").over(in_source).alias("n_source")))
    in_bucket = Window.partitionBy(*_KEY).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    phase = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "stratum"), 44) + 0.5) / float(1 << 20)
    firsts = written(
        rows.join(offsets, _KEY)
        .withColumn("first", F.col("before") + F.sum("weight").over(in_bucket) - F.col("weight"))
        .select("stratum", *_ORDER, "weight", "first", "n_source"), "shard-ranks")
    ranked = (unfolded(firsts, block)
              .withColumn("fraction", (F.col("first") + F.col("copy") + phase) / F.col("n_source"))
              .select("stratum", *_ORDER, "copy", "fraction"))

    ranked = ranked.withColumn("part", F.floor(F.col("fraction") * float(1 << bits)))
    before = (ranked.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")))
    in_part = Window.partitionBy("part").orderBy("fraction", "stratum", *_ORDER, "copy")
    placed = ranked.join(before, "part").withColumn("pos", F.col("before") + F.row_number().over(in_part) - 1)
    shard = F.expr(f"cast(pos * {shards} div {max(1, total)} as int)")
    start = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard)
            .select("doc_id", F.when(F.col("stratum") != "", F.expr("substring(stratum, 2)")).alias("source"), "size", "text_crc32", "shard",
                    (F.col("pos") - start).cast("long").alias("slot")))


def op1_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")
