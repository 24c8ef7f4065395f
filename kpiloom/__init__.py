"""kpiloom: heterogeneous wide statistical exports -> one long, privacy-aware
KPI table, built as Spark DataFrame plans.

Layout
  functions/  Column -> Column expressions (names, markers, numbers, labels, derived measures)
  sources/    driver tables, fixtures, CSV scans by header group, sinks, master union
  operators/  DataFrame -> DataFrame operators (demographic mapping, wide->long,
              event tiers, survey means, dedupe, dashboard, data quality)
  plans/      the thirteen source specs and the query registry used by __spark_entry__
  streaming/  Structured Streaming ingestion equal to the batch job
"""

from kpiloom.schema import KPI_COLUMNS, KPI_SCHEMA, LOGICAL_KEY  # noqa: F401
