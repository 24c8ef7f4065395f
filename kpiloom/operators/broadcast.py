"""Broadcast only behind a size check.

A side is broadcast when a bounded count proves it has at most ``max_rows``
rows; otherwise the plain frame is returned and the planner picks a shuffle
join (AQE can still convert it at runtime from real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSION_MAX_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> bool:
    # limit(n + 1).count() stops after n + 1 rows: the check itself is bounded
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it provably has <= max_rows rows, else ``df``.

    ``known_rows`` skips the check for frames built from driver-side config
    whose length is already known.
    """
    small = (known_rows <= max_rows) if known_rows is not None else is_small(df, max_rows)
    return F.broadcast(df) if small else df
