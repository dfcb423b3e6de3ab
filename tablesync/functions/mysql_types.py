"""MySQL column types mapped to stream, target and Spark types, as column rules.

A *type token* is the type as ``SHOW CREATE TABLE`` prints it, such as
``decimal(18,2)``. The rules run inside Spark over the catalog's columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widest decimal a target column may have, and the scale given to wider ones (fixed values).
MAX_PRECISION = 27
MAX_SCALE = 9
CLAMPED_SCALE = 8


def _first_match(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    head, *rest = rules
    chain = reduce(lambda c, rule: c.when(*rule), rest, F.when(*head))
    return chain.otherwise(otherwise)


def stream_type(token: Column) -> Column:
    return _first_match(
        [
            (token.contains("tinyint"), F.lit("tinyint")),
            (token.contains("bigint"), F.lit("bigint")),
            (token.contains("mediumint"), F.lit("int")),
            (token.contains("text"), F.lit("string")),
            (token.contains("int"), F.lit("int")),
            ((token == "datetime") | token.contains("timestamp"), F.lit("timestamp(3)")),
        ],
        token,
    )


def clamp_decimal(token: Column) -> Column:
    arguments = F.split(F.substring_index(F.substring_index(token, ")", 1), "(", -1), ",")
    precision = F.get(arguments, 0).try_cast("int")
    scale = F.get(arguments, 1).try_cast("int")
    clamped = F.format_string(
        "decimal(%d,%d)",
        F.least(precision, F.lit(MAX_PRECISION)),
        F.when(scale > MAX_SCALE, F.lit(CLAMPED_SCALE)).otherwise(scale),
    )
    fits = (precision <= MAX_PRECISION) & (scale <= MAX_SCALE)
    return F.when(scale.isNull() | fits, token).otherwise(clamped)


def target_type(token: Column) -> Column:
    return _first_match(
        [
            (token.contains("medium"), F.replace(token, F.lit("medium"), F.lit(""))),
            (token.contains("varchar"), F.lit("string")),
            (token.contains("timestamp"), F.lit("datetime")),
            (token.contains("decimal"), clamp_decimal(token)),
        ],
        token,
    )


def base_type(token: Column) -> Column:
    """The type's name without arguments."""
    return F.lower(F.substring_index(token, "(", 1))


def spark_type(token: Column, unsigned: Column, base: Column | None = None) -> Column:
    """The Spark type that holds every value of the source column."""
    base = base_type(token) if base is None else base

    def by_sign(signed: str, wider: str) -> Column:
        return F.when(unsigned, F.lit(wider)).otherwise(F.lit(signed))

    return _first_match(
        [
            (base == "tinyint", by_sign("tinyint", "smallint")),
            (base == "smallint", by_sign("smallint", "int")),
            (base.isin("mediumint", "year"), F.lit("int")),
            (base.isin("int", "integer"), by_sign("int", "bigint")),
            (base == "bigint", by_sign("bigint", "decimal(20,0)")),
            (base.isin("datetime", "timestamp"), F.lit("timestamp_ntz")),
            (base == "date", F.lit("date")),
            (base == "decimal", clamp_decimal(token)),
            (base.isin("float", "double"), base),
            (base.endswith("blob") | base.endswith("binary"), F.lit("binary")),
            (token == "bit(1)", F.lit("boolean")),
        ],
        F.lit("string"),
    )


def logical_type(token: Column, base: Column | None = None) -> Column:
    """The wire encoding a change event uses for the column (fixed values)."""
    base = base_type(token) if base is None else base
    # Datetimes with more than three fractional digits are sent in microseconds.
    fine = F.substring(token, -2, 1).isin("4", "5", "6")
    return _first_match(
        [
            ((base == "datetime") & fine, F.lit("io.debezium.time.MicroTimestamp")),
            (base == "datetime", F.lit("io.debezium.time.Timestamp")),
            (base == "timestamp", F.lit("io.debezium.time.ZonedTimestamp")),
            (base == "date", F.lit("io.debezium.time.Date")),
            (base == "time", F.lit("io.debezium.time.MicroTime")),
            (base.endswith("blob") | base.endswith("binary"), F.lit("base64")),
        ],
        F.lit("raw"),
    )


def wire_type(logical: Column, target: Column) -> Column:
    """The JSON type to read: decimals and unsigned 64-bit numbers stay text until cast."""
    return _first_match(
        [
            (logical.isin("io.debezium.time.ZonedTimestamp", "base64"), F.lit("string")),
            (logical == "io.debezium.time.Date", F.lit("int")),
            (logical != "raw", F.lit("bigint")),
            (target.startswith("decimal"), F.lit("string")),
        ],
        target,
    )
