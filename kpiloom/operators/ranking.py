"""Exact 1-based position within a group without one task per group.

``Window.partitionBy(g).orderBy(..)`` moves every row of a group into one
task; for a group that holds a large share of the data that task is the job.
Here the rows are range-partitioned on (group, order keys) so a large group
spreads over many tasks, each task numbers its sorted rows locally, and a small
table of per-(task, group) counts turns local numbers into global positions.
The offset table has at most (#tasks + #groups) rows.

Consistency: the numbered rows are written once with a reliable
``checkpoint()`` under the shared ``spark.checkpoint.dir`` before the counts
and the join read them.  Two independent range exchanges could sample
different bounds and number rows differently; after the checkpoint both
consumers read the same materialised ids, whatever the planner reuses, and
lost executors cannot change them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import checkpoint_root

_LOW_BITS = (1 << 33) - 1


def position_within(df: DataFrame, group: list[str], order: list[Column], out: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = row_number() over (partition by group order by order).

    ``order`` must make the order total within a group (add a unique tie-break).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group] + list(order)
    s = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id = (partition index << 33) + row index in the partition,
    # and the partition rows are sorted at this point
    s = s.withColumn("_pos_id", F.monotonically_increasing_id())
    s = s.withColumn("_pos_task", F.shiftright("_pos_id", 33)) \
         .withColumn("_pos_idx", F.col("_pos_id").bitwiseAND(F.lit(_LOW_BITS)))
    checkpoint_root(spark)
    s = s.checkpoint(eager=True)
    counts = s.groupBy("_pos_task", *group).agg(F.min("_pos_idx").alias("_pos_first"),
                                                F.count(F.lit(1)).alias("_pos_n"))
    before = Window.partitionBy(*group).orderBy("_pos_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_pos_off", F.coalesce(F.sum("_pos_n").over(before), F.lit(0)))
    # a range partition holds one contiguous key range, so (task, group) pairs number at
    # most tasks + groups - 1; whether that is broadcast is left to the planner
    offsets = offsets.select("_pos_task", *group, "_pos_first", "_pos_off")
    joined = s.join(offsets, ["_pos_task", *group])
    return joined.withColumn(out, F.col("_pos_off") + F.col("_pos_idx") - F.col("_pos_first") + 1) \
                 .drop("_pos_id", "_pos_task", "_pos_idx", "_pos_first", "_pos_off")
