"""Wire encodings of dates and times, decoded into zone-free Spark types.

Every expression gives the same value under any session time zone: instants are
turned into microseconds since the epoch and added to a zone-free epoch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def datetime_from_millis(col: Column) -> Column:
    return F.timestamp_add("MILLISECOND", col, F.expr(EPOCH))


def datetime_from_micros(col: Column) -> Column:
    return F.timestamp_add("MICROSECOND", col, F.expr(EPOCH))


def datetime_from_nanos(col: Column) -> Column:
    return datetime_from_micros(_floor_div(col, 1000))


def date_from_epoch_day(col: Column) -> Column:
    return F.date_from_unix_date(col.cast("int"))


def local_datetime_from_iso(col: Column, time_zone: str) -> Column:
    """ISO instant such as ``2020-07-17T18:00:22Z`` as wall-clock time in ``time_zone``.

    Text without an offset is taken as UTC; text that is no instant gives NULL.
    """
    with_offset = F.when(col.rlike(r":.*(Z|z|[+-]\d{1,2}(:?\d{2})?)$"), col).otherwise(F.concat(col, F.lit("Z")))
    utc = datetime_from_micros(F.unix_micros(with_offset.try_cast("timestamp")))
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)


def time_from_micros(col: Column) -> Column:
    """Microseconds as ``HH:mm:ss[.ffffff]``; MySQL allows -838:59:59 to 838:59:59."""
    size = F.abs(col)
    seconds = _floor_div(size, 1_000_000)
    fraction = size % 1_000_000
    text = F.concat(
        F.when(col < 0, F.lit("-")).otherwise(F.lit("")),
        _two_digits(_floor_div(seconds, 3600)),
        F.lit(":"),
        _two_digits(_floor_div(seconds, 60) % 60),
        F.lit(":"),
        _two_digits(seconds % 60),
    )
    return F.when(fraction == 0, text).otherwise(
        F.concat(text, F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
    )


def time_from_nanos(col: Column) -> Column:
    return time_from_micros(_floor_div(col, 1000))


def _floor_div(col: Column, n: int) -> Column:
    """Integer division towards minus infinity, without a detour through double."""
    exact = col.cast("bigint") - F.pmod(col.cast("bigint"), F.lit(n).cast("bigint"))
    return F.call_function("div", exact, F.lit(n).cast("bigint"))


def _two_digits(col: Column) -> Column:
    text = col.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


Converter = Callable[[Column, str], Column]

# Logical type names as they appear on the wire (fixed values).
CONVERTERS: dict[str, Converter] = {
    "io.debezium.time.Timestamp": lambda c, tz: datetime_from_millis(c),
    "io.debezium.time.MicroTimestamp": lambda c, tz: datetime_from_micros(c),
    "io.debezium.time.NanoTimestamp": lambda c, tz: datetime_from_nanos(c),
    "io.debezium.time.Date": lambda c, tz: date_from_epoch_day(c),
    "io.debezium.time.ZonedTimestamp": local_datetime_from_iso,
    "io.debezium.time.MicroTime": lambda c, tz: time_from_micros(c),
    "io.debezium.time.NanoTime": lambda c, tz: time_from_nanos(c),
    "base64": lambda c, tz: F.unbase64(c),
    "raw": lambda c, tz: c,
}


def register_converter(logical: str, convert: Converter) -> None:
    """Add or replace the decoding of one logical type."""
    CONVERTERS[logical] = convert


def convert(col: Column, logical: str, time_zone: str) -> Column:
    if logical not in CONVERTERS:
        raise ValueError(f"no converter for logical type {logical}")
    return CONVERTERS[logical](col, time_zone)
