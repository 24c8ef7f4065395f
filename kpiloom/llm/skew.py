"""Totals of a key told back to all rows that hold the key, hot keys included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1 << 16


def looked_up(rows: DataFrame, totals: DataFrame, key: str, weight: str, heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """``rows`` inner-joined with ``totals`` (one row a key; ``weight``: how many
    rows hold it).  Keys with more than 1 / ``heavy_keys`` of all the weight are
    fewer than ``heavy_keys``, so that many small rows at most are broadcast, and
    a row with such a key stays where it is.  All other keys are joined by a
    shuffle in which none is hot.  Both frames should be written tables, since
    each is read twice."""
    whole = totals.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) > max(whole // heavy_keys, 1)
    known = rows.join(F.broadcast(totals.filter(heavy)), key, "inner")
    rest = rows.join(F.broadcast(totals.filter(heavy).select(key)), key, "left_anti")
    return known.unionByName(rest.join(totals.filter(~heavy), key, "inner"))
