"""tablesync: keep keyed tables in step with their operational sources, on Spark.

Change events or incremental scans come in as DataFrames; typed, masked and
routed rows go out to one keyed target table per source table.
"""

from tablesync.spec import ColumnSpec, MaskRules, TableSpec

__all__ = ["ColumnSpec", "MaskRules", "TableSpec"]
