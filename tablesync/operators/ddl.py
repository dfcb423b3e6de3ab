"""Catalog jobs over table definitions as ``SHOW CREATE TABLE`` prints them.

Input is a DataFrame ``(table_name, ddl)``. Every column sits on its own line;
key lines do not start with a quoted name, so they are never taken for columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions import mysql_types
from tablesync.spec import ColumnSpec, TableSpec

# Shape of a definition line: quoted name, type with optional arguments, comment text.
NAME = r"`((?:[^`]|``)+)`"
TYPE = r"(\w+(?:\((?:'(?:[^']|'')*'|[^')])*\))?)"
COLUMN_LINE = rf"\A\s+{NAME} {TYPE}( unsigned)?"
COLUMN_COMMENT = r" COMMENT '((?:[^']|'')*)',?\s*\z"
PRIMARY_KEY = r"(?m)^\s+PRIMARY KEY \(((?:`(?:[^`]|``)+`(?:\(\d+\))?,?\s*)+)\)"
TABLE_COMMENT = r"(?m)^\).* COMMENT='((?:[^']|'')*)'"


def _unquote(col: Column, quote: str) -> Column:
    return F.replace(col, F.lit(quote * 2), F.lit(quote))


def ddl_lines(ddls: DataFrame) -> DataFrame:
    """``table_name, line_no, line``; numbers start at 1."""
    exploded = ddls.select("table_name", F.posexplode(F.split("ddl", "\r?\n")))
    return exploded.select("table_name", (F.col("pos") + 1).alias("line_no"), F.col("col").alias("line"))


def ddl_columns(ddls: DataFrame) -> DataFrame:
    """One row per column, with its 0-based index, comment and mapped types."""
    text = F.ltrim("line")
    lines = ddl_lines(ddls).select("table_name", "line_no", "line").where(text.startswith("`"))
    read = lines.select(
        "table_name",
        (F.col("line_no") - 2).alias("idx"),
        _unquote(F.regexp_extract("line", COLUMN_LINE, 1), "`").alias("column_name"),
        F.regexp_extract("line", COLUMN_LINE, 2).alias("mysql_type"),
        (F.regexp_extract("line", COLUMN_LINE, 3) != "").alias("unsigned"),
        F.when(F.contains(F.col("line"), F.lit(" COMMENT '")), _unquote(F.regexp_extract("line", COLUMN_COMMENT, 1), "'"))
        .otherwise("")
        .alias("comment"),
    )
    # Step by step, so that each step's results are computed once.
    token, base = F.col("mysql_type"), F.col("_base")
    based = read.withColumn("_base", mysql_types.base_type(token))
    typed = based.withColumns(
        {
            "stream_type": mysql_types.stream_type(token),
            "target_type": mysql_types.target_type(token),
            "spark_type": mysql_types.spark_type(token, F.col("unsigned"), base),
            "logical_type": mysql_types.logical_type(token, base),
        }
    )
    wire = mysql_types.wire_type(F.col("logical_type"), F.col("spark_type"))
    return typed.withColumn("wire_type", wire).drop("_base")


def ddl_primary_keys(ddls: DataFrame) -> DataFrame:
    """Key columns in key order (empty if there is no key) and the table's comment."""
    quoted = F.regexp_extract_all(F.regexp_extract("ddl", PRIMARY_KEY, 1), F.lit(NAME), F.lit(1))
    return ddls.select(
        "table_name",
        F.transform(quoted, lambda k: _unquote(k, "`")).alias("keys"),
        _unquote(F.regexp_extract("ddl", TABLE_COMMENT, 1), "'").alias("table_comment"),
    )


def tables_without_key(ddls: DataFrame) -> DataFrame:
    keys = ddl_primary_keys(ddls)
    return keys.where(F.size("keys") == 0).select("table_name", F.lit("no primary key").alias("error"))


def target_ddl(ddls: DataFrame, buckets: int, db: str = "ods") -> DataFrame:
    """Spark DDL of every target: mapped types, comments, hash-distributed on the key.

    ``targets`` may be in the input as column ``target``; else the table's own name is used.
    A table has a few thousand columns at most, so gathering one table's lines is bounded.
    """
    text = F.concat(
        F.lit("  `"),
        F.replace(F.col("column_name"), F.lit("`"), F.lit("``")),
        F.lit("` "),
        F.col("spark_type"),
        F.when(F.col("comment") != "", F.concat(F.lit(" COMMENT '"), sql_quoted("comment"), F.lit("'"))).otherwise(""),
    )
    per_table = (
        ddl_columns(ddls)
        .select("table_name", F.struct("idx", text.alias("text")).alias("line"))
        .groupBy("table_name")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["text"]), ",\n").alias("body"))
    )
    key_list = F.concat(F.lit("`"), F.array_join("keys", "`, `"), F.lit("`"))
    target = F.col("target") if "target" in ddls.columns else F.col("table_name")
    keys = ddl_primary_keys(ddls).where(F.size("keys") > 0)
    named = ddls.select("table_name", target.alias("target"))
    return (
        per_table.join(keys, "table_name")
        .join(named, "table_name")
        .select(
            "table_name",
            F.concat(
                F.lit(f"CREATE TABLE IF NOT EXISTS `{db}`.`"),
                F.col("target"),
                F.lit("` (\n"),
                F.col("body"),
                F.lit("\n) USING parquet CLUSTERED BY ("),
                key_list,
                F.lit(f") INTO {buckets} BUCKETS COMMENT '"),
                sql_quoted("table_comment"),
                F.lit("'"),
            ).alias("ddl"),
        )
    )


def sql_quoted(name: str) -> Column:
    return F.replace(F.replace(F.col(name), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def spec_rows(ddls: DataFrame, db: str | None = None) -> DataFrame:
    """What a job knows of its tables as rows: a row for each column, ``key_position`` from 1, 0 for no key column.

    Definitions may carry ``db_name``; then one database is chosen. Tables without a key have no rows.
    """
    if db is not None:
        ddls = ddls.where(F.col("db_name") == db)
    keys = ddl_primary_keys(ddls).where(F.size("keys") > 0).select("table_name", "keys", "table_comment")
    return (
        ddl_columns(ddls)
        .join(keys, "table_name")
        .select(
            "table_name", "idx", "column_name", "spark_type", "logical_type", "wire_type", "comment",
            F.coalesce(F.array_position("keys", F.col("column_name")), F.lit(0)).cast("int").alias("key_position"),
            "table_comment",
        )
    )


def table_specs(ddls: DataFrame, targets: dict[str, str] | None = None) -> dict[str, TableSpec]:
    """The specs of a job's tables. Definitions only: rows collected are the tables' columns."""
    targets = targets or {}
    twice = [r.table_name for r in ddls.groupBy("table_name").count().where("count > 1").collect()]
    if twice:
        raise ValueError(f"several definitions of {sorted(twice)}: choose one database")
    lost = [r.table_name for r in tables_without_key(ddls).collect()]
    if lost:
        raise ValueError("; ".join(f"table {name} has no primary key" for name in sorted(lost)))
    columns: dict[str, list] = {}
    for row in spec_rows(ddls).orderBy("table_name", "idx").collect():
        columns.setdefault(row.table_name, []).append(row)
    specs = {}
    for name, rows in columns.items():
        keys = sorted((r.key_position, r.column_name) for r in rows if r.key_position)
        specs[name] = TableSpec(
            name,
            targets.get(name, name),
            tuple(k for _, k in keys),
            tuple(ColumnSpec(r.column_name, r.spark_type, r.logical_type, r.wire_type, r.comment) for r in rows),
            rows[0].table_comment,
        )
    return specs
