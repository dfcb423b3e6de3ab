"""Split a change log by table and set aside what no target takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.sources.change_events import action


def classify(events: DataFrame, known_tables: list[str], truncates: bool = False) -> DataFrame:
    """Add ``_action``: upsert, delete, if wanted truncate, quarantine, or ``unknown_table``."""
    known = F.coalesce(F.col("table").isin(*known_tables), F.lit(False))
    return events.withColumn(
        "_action", F.when(F.col("_bad").isNull() & ~known, "unknown_table").otherwise(action(truncates))
    )


def route(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events with the ``target`` the catalog (``table, target``) gives their table.

    A catalog has a row for each table and goes to the events; shuffled, all events of a table would meet in one task.
    """
    return events.join(F.broadcast(catalog.select("table", "target")), "table")


def unknown_tables(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events whose table the catalog, which goes to the events as in ``route``, does not list."""
    return events.join(F.broadcast(catalog.select("table")), "table", "left_anti")


def action_counts(classified: DataFrame) -> DataFrame:
    """Events per table and action; all unlisted tables count under one row."""
    table = F.when(F.col("_action").isin("upsert", "delete"), F.col("table")).otherwise(F.lit(None))
    return classified.groupBy(table.alias("table"), "_action").agg(F.count("*").alias("events"))
