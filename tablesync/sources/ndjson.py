"""Line-delimited JSON, one or many objects per value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.json_rows import JSON_FORMATS, with_fields


def explode_lines(rows: DataFrame, value: str, schema: str, delimiter: str = "\n", keep: list[str] | None = None):
    """One row per JSON line of ``value``; empty lines are skipped."""
    keep = keep or []
    lines = rows.select(*keep, F.explode(F.split(F.col(value), delimiter)).alias("_line"))
    return with_fields(lines.where(F.trim("_line") != ""), keep, F.col("_line"), schema)


def to_lines(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every row as one JSON line in ``value``, nulls included."""
    keep = keep or []
    data = [c for c in rows.columns if c not in keep]
    return rows.select(*keep, F.to_json(F.struct(*data), JSON_FORMATS).alias("value"))
