"""Incremental back-fill: which column says when a row was last changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that mark a row's last change, in order of preference (fixed values).
FIRST_CHOICE = "last_modify"
UPDATE_COLUMNS = ("update_timestamp", "update_time", "update_date", "operator_time")
EVENT_COLUMNS = ("occur_time", "in_bill_time")

FULL = "full"
EITHER = "either"
UNREGISTERED = "unregistered"

# The columns each rule compares with the start time.
RULE_COLUMNS: dict[str, tuple[str, ...]] = {
    FULL: (),
    EITHER: EVENT_COLUMNS,
    **{c: (c,) for c in (FIRST_CHOICE, *UPDATE_COLUMNS, *EVENT_COLUMNS)},
}


def choose_filters(columns: DataFrame) -> DataFrame:
    """One row per table: ``table_name, rule``, from its columns' names and types.

    A table without any date and time in names or types is loaded in full; one
    whose update column is not known gets the rule ``unregistered``.
    """
    described = F.concat_ws(" ", "column_name", "mysql_type")
    has = {c: F.bool_or(F.col("column_name") == c).alias(c) for c in (FIRST_CHOICE, *UPDATE_COLUMNS, *EVENT_COLUMNS)}
    flags = columns.groupBy("table_name").agg(
        *has.values(),
        F.bool_or(described.contains("time")).alias("_time"),
        F.bool_or(described.contains("date")).alias("_date"),
    )
    return flags.select("table_name", _rule(F.col).alias("rule"))


def choose_filters_by_text(ddls: DataFrame) -> DataFrame:
    """The same choice from the whole definition text, comments and types included."""

    def in_text(word: str) -> Column:
        return F.col("ddl").contains({"_time": "time", "_date": "date"}.get(word, word))

    return ddls.select("table_name", _rule(in_text).alias("rule"))


def _rule(has) -> Column:
    rule = F.when(has(FIRST_CHOICE), FIRST_CHOICE).when(~has("_time") | ~has("_date"), FULL)
    for c in UPDATE_COLUMNS:
        rule = rule.when(has(c), c)
    first, second = EVENT_COLUMNS
    rule = rule.when(has(first) & has(second), EITHER).when(has(first), first).when(has(second), second)
    return rule.otherwise(UNREGISTERED)


def predicate_text(rule: Column, since: str) -> Column:
    """The rule as SQL text, for reports."""
    text = F.when(rule == FULL, F.lit("1=1"))
    for name, columns in RULE_COLUMNS.items():
        if columns:
            text = text.when(rule == name, F.lit(" or ".join(f"{c}>='{since}'" for c in columns)))
    return text


def predicate_sql(rule: str, since: str, quote: Callable[[str], str] = str) -> str | None:
    """The rule as a condition for the source's SQL; None if it takes all rows."""
    return " or ".join(f"{quote(c)} >= '{since}'" for c in RULE_COLUMNS.get(rule, ())) or None


def rows_since(rows: DataFrame, rule: str, since: str) -> DataFrame:
    """Rows changed at or after ``since``. The bound has the column's own type, so it is pushed down."""
    if rule == UNREGISTERED:
        raise ValueError("no known update column")
    condition = None
    for name in RULE_COLUMNS[rule]:
        test = F.col(name) >= F.lit(since).cast(rows.schema[name].dataType)
        condition = test if condition is None else condition | test
    return rows if condition is None else rows.where(condition)
