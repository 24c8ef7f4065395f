"""Blocked Bloom filter as a table: a key sets one bit in each of the eight
64-bit words of its block.  Built with one aggregation (bit_or per block) and
probed with one broadcast join on the block number, all in the JVM.  The
number of blocks follows the keys up to ``max_blocks`` (72 bytes each), so what
is broadcast is bounded; more keys only raise the share of false positives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import spare_prefix

WORDS = 8
KEYS_PER_BLOCK = 32
MAX_BLOCKS = 1 << 18


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """The bit that the key sets in each word of its block."""
    h = F.xxhash64(F.lit(1), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _w0 .. _w7): at most ``blocks`` rows."""
    masks = [m.alias(f"_m{i}") for i, m in enumerate(_masks(F.col(key)))]
    return (keys.select(_block(F.col(key), blocks).alias("_block"), *masks)
            .groupBy("_block").agg(*(F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(WORDS))))


def probed(rows: DataFrame, keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS, *, prefix: str = "_") -> DataFrame:
    """``rows`` with the column ``_possible``: false only where ``key`` is not
    among the column of that name in ``keys``.  No column of ``rows`` may begin with
    ``prefix``, which that column and those used here begin with."""
    blocks = 1 << max(0, min(max_blocks.bit_length() - 1, (keys.count() // KEYS_PER_BLOCK).bit_length()))
    possible = F.lit(True)
    for i, mask in enumerate(_masks(F.col(key))):
        possible &= F.col(f"{prefix}w{i}").bitwiseAND(mask) != 0
    filters = bloom_blocks(keys, key, blocks)
    filters = filters.select(*(F.col(c).alias(prefix + c[1:]) for c in filters.columns))
    return (rows.withColumn(f"{prefix}block", _block(F.col(key), blocks))
            .join(F.broadcast(filters), f"{prefix}block", "left")
            .withColumn(f"{prefix}possible", F.coalesce(possible, F.lit(False)))
            .select(*rows.columns, f"{prefix}possible"))


def left_out(rows: DataFrame, keys: DataFrame, on: dict[str, Column]) -> DataFrame:
    """The rows whose keys don't stand in ``keys`` (columns named like ``on``,
    whose values say how a row's keys are made; nulls are equal).  The filter
    lets nearly all such rows pass where they are; only possible hits, with
    whatever long columns they have, meet ``keys`` in an exact anti join."""
    own, inner = spare_prefix(rows.columns), spare_prefix(rows.columns) + "_"
    names, key = [f"{own}k_{name}" for name in on], f"{own}key"
    wanted = keys.select(*(F.col(name).alias(k) for name, k in zip(on, names))).distinct()
    found = probed(rows.withColumns({**dict(zip(names, on.values())), key: F.xxhash64(*on.values())}),
                   wanted.select(F.xxhash64(*names).alias(key)), key, prefix=inner)
    same = F.lit(True)
    for k in names:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    sure = found.filter(f"not {inner}possible").select(rows.columns)
    return sure.unionByName(found.filter(f"{inner}possible").alias("l").join(wanted.alias("r"), same, "left_anti").select(rows.columns))
