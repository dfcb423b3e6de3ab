"""Images of change events as typed, masked rows of one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.json_rows import with_fields
from tablesync.functions.temporal import convert
from tablesync.operators.sensitive import mask_columns
from tablesync.sources.change_events import DELETE_OP, action, binlog_position
from tablesync.spec import DEFAULT_TIME_ZONE, NO_MASKING, ColumnSpec, MaskRules, TableSpec


def typed_rows(
    events: DataFrame,
    spec: TableSpec,
    rules: MaskRules = NO_MASKING,
    time_zone: str = DEFAULT_TIME_ZONE,
    seq: Column | None = None,
    new_columns: str = "ignore",
    on_overflow: str = "quarantine",
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """The table's columns plus ``_op``, ``_seq`` and ``_bad``, and the columns ``keep`` of the events.

    A delete is read from the old image, anything else from the new one; both
    get the same conversions. ``_bad`` names why a row cannot be applied.
    ``new_columns="fail"`` stops on columns the catalog does not know.
    A value that its type cannot hold makes the row bad; with ``on_overflow="null"`` it
    is stored as NULL, with ``"fail"`` it stops the job. A row without a position is bad.
    """
    if on_overflow not in ("quarantine", "null", "fail"):
        raise ValueError(f"on_overflow must be quarantine, null or fail, not {on_overflow}")
    image = F.when(F.col("op") == DELETE_OP, F.col("before")).otherwise(F.col("after"))
    if new_columns == "fail":
        image = _without_new_columns(image, spec)
    elif new_columns != "ignore":
        raise ValueError(f"new_columns must be ignore or fail, not {new_columns}")

    wire = ", ".join(f"`{c.name}` {c.wire_type}" for c in spec.columns)
    position = binlog_position() if seq is None else seq
    rows = with_fields(
        events, [action().alias("_op"), position.alias("_seq"), *keep], image, wire, corrupt="_bad_image"
    )
    no_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in spec.keys])
    bad = (
        F.when(F.col("_op") == "quarantine", "unknown operation")
        .when(F.col("_bad_image").isNotNull(), "unreadable image")
        .when(no_key, "missing key")
        .when(F.col("_seq").isNull(), "no position")
    )
    values = {c.name: _target_value(c, time_zone) for c in spec.columns}
    lost = {n: F.col(f"`{n}`").isNotNull() & v.isNull() for n, v in values.items()}
    if on_overflow == "quarantine":
        for name, is_lost in lost.items():
            bad = bad.when(is_lost, _cannot_hold(name))
    elif on_overflow == "fail":
        types = {c.name: c.target for c in spec.columns}
        values = {
            n: F.when(lost[n], F.raise_error(_cannot_hold(n)).cast(types[n])).otherwise(v) for n, v in values.items()
        }
    columns = [v.alias(n) for n, v in values.items()]
    return mask_columns(rows.select(*columns, "_op", "_seq", bad.alias("_bad"), *keep), spec, rules)


def _cannot_hold(name: str) -> Column:
    return F.concat(F.lit(f"column {name} cannot hold "), F.col(f"`{name}`").cast("string"))


def _without_new_columns(image: Column, spec: TableSpec) -> Column:
    """The image itself, or an error that names the columns the catalog does not know."""
    unknown = F.array_except(F.json_object_keys(image), F.array(*[F.lit(n) for n in spec.column_names]))
    message = F.concat(F.lit(f"table {spec.table} has new columns: "), F.array_join(unknown, ", "))
    return F.when(F.size(unknown) > 0, F.raise_error(message).cast("string")).otherwise(image)


def _target_value(column: ColumnSpec, time_zone: str) -> Column:
    """The value in the target's type, NULL if it does not fit, whatever the session's ANSI mode."""
    value = convert(F.col(f"`{column.name}`"), column.logical, time_zone)
    return value if column.logical == "raw" and column.wire_type == column.target else value.try_cast(column.target)
