"""postura: security-posture reports as Spark DataFrame plans.

Layout:
  sources/    table registry (Parquet, JDBC, catalog, in-memory frames), CSV sink
  functions/  Column-level helpers (labels, rounding, vulnerability score, JSON, time)
  operators/  reusable relational building blocks (top-k per key, any-key join, month spine, unpivot)
  plans/      shared blocks and the report catalogue
"""

from postura.plans.catalog import REPORTS, build_report, report_keys
from postura.sources.tables import Tables

__all__ = ["REPORTS", "Tables", "build_report", "report_keys"]
