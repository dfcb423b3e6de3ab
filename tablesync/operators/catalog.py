"""Lookups over metadata tables: source and target of every table, missing targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.latest import latest_per_key


def target_name(hive_table: Column, source_prefix: str = "src_", target_prefix: str = "ods_") -> Column:
    return F.replace(hive_table, F.lit(source_prefix), F.lit(target_prefix))


def table_prefix(target: Column, table: Column) -> Column:
    """What a target's name has in front of the source table's name, for whole-database sync."""
    return F.replace(target, table, F.lit(""))


def prefixed(table: str, prefix: str) -> str:
    """The target of a table in whole-database sync, the inverse of ``table_prefix``."""
    return f"{prefix}{table}"


def catalog_lookup(tables: DataFrame, imports: DataFrame, connections: DataFrame) -> DataFrame:
    """Source connection and target of every wanted table.

    ``tables`` has ``table_name`` and, to tell apart equal names, ``db_name``.
    An import entry counts if its ``hive_table`` ends in the table's name; of
    several the one with the smallest ``id`` is taken. ``status`` says what is
    missing. The joins are on equality, with the name test as an extra
    condition; Spark broadcasts a side only if it is small enough.
    """
    on_db = ["table_name"] + (["db_name"] if "db_name" in tables.columns else [])
    wanted = tables.select(*on_db).distinct()
    entries = imports.select("id", "connection_id", "db_name", "table_name", "hive_table").where(
        F.col("hive_table").endswith(F.col("table_name"))
    )
    entries = latest_per_key(entries, on_db, -F.col("id"))
    found = wanted.join(entries, on_db, "left").join(
        connections.select("connection_id", "hostname", "port", "jdbc_extend"), "connection_id", "left"
    )
    status = (
        F.when(F.col("id").isNull(), "no import entry").when(F.col("hostname").isNull(), "no connection").otherwise("ok")
    )
    return found.select(
        "table_name",
        "db_name",
        "connection_id",
        target_name(F.col("hive_table")).alias("target"),
        F.when(
            F.col("hostname").isNotNull(),
            F.concat(
                F.lit("jdbc:mysql://"), "hostname", F.lit(":"), F.col("port").cast("string"), F.lit("/"), "db_name",
                F.when(F.coalesce("jdbc_extend", F.lit("")) != "", F.concat(F.lit("?"), "jdbc_extend")).otherwise(""),
            ),
        ).alias("url"),
        status.alias("status"),
    )


def missing_targets(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Targets (``db, target``) that do not exist yet."""
    return wanted.select("db", "target").distinct().join(existing.select("db", "target"), ["db", "target"], "left_anti")
