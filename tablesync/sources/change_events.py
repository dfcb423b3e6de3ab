"""Change events as rows: read, parse the envelope, choose scope and start."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.json_rows import with_fields

# Attributes a MySQL change event carries about its origin (fixed values).
SOURCE_FIELDS = {
    "db": "string",
    "table": "string",
    "ts_ms": "bigint",
    "file": "string",
    "pos": "bigint",
    "row": "bigint",
    "gtid": "string",
    "server_id": "bigint",
    "snapshot": "string",
}

_SOURCE_DDL = ", ".join(f"`{n}`: {t}" for n, t in SOURCE_FIELDS.items())
ENVELOPE = f"`source` struct<{_SOURCE_DDL}>, `op` string, `before` string, `after` string"

UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
TRUNCATE_OP = "t"

# ``epoch`` tells servers that took over from one another apart, see ``sources.epochs``.
SEQ_TYPE = "struct<epoch:bigint,file_no:bigint,pos:bigint,row:bigint>"


def read_change_events(
    spark: SparkSession, path: str, streaming: bool = False, max_files_per_batch: int | None = None
) -> DataFrame:
    """One JSON event per line in text files, as a column ``value``."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.format("text").load(path)


def parse_envelope(events: DataFrame, value: str = "value") -> DataFrame:
    """``source`` attributes, ``op`` and the raw JSON of both images.

    A missing image becomes ``{}``. Text that is no event is kept in ``_bad``.
    """
    text = F.col(value).cast("string")
    parsed = with_fields(events, [text.alias("_text")], text, ENVELOPE, corrupt="_bad")
    return parsed.select(
        *[F.col(f"source.{n}").alias(n) for n in SOURCE_FIELDS],
        "op",
        F.coalesce("before", F.lit("{}")).alias("before"),
        F.coalesce("after", F.lit("{}")).alias("after"),
        F.when(F.col("_text").isNull(), F.lit("")).otherwise(F.col("_bad")).alias("_bad"),
    )


def action(truncates: bool = False) -> Column:
    """What an event asks for: ``upsert``, ``delete``, if wanted ``truncate`` or, for anything else, ``quarantine``."""
    known = F.when(F.col("op").isin(*UPSERT_OPS), "upsert").when(F.col("op") == DELETE_OP, "delete")
    if truncates:
        known = known.when((F.col("op") == TRUNCATE_OP) & binlog_position().isNotNull(), "truncate")
    return F.when(F.col("_bad").isNotNull(), "quarantine").otherwise(F.coalesce(known, F.lit("quarantine")))


def binlog_position(
    file: Column | None = None, pos: Column | None = None, row: Column | None = None, epoch: Column | None = None
) -> Column:
    """Total order of events: the server's epoch, number of the log file, offset, row in the event.

    Without an epoch all events are taken for those of one server. NULL for an event without a file
    number, an offset or a known epoch, whose place nobody knows.
    """
    file = F.col("file") if file is None else file
    pos = F.col("pos") if pos is None else pos
    row = F.col("row") if row is None else row
    number = F.substring_index(file, ".", -1).try_cast("bigint")
    epoch = F.lit(0) if epoch is None else epoch
    place = F.struct(
        epoch.cast("bigint").alias("epoch"),
        number.alias("file_no"),
        pos.cast("bigint").alias("pos"),
        F.coalesce(row, F.lit(0)).cast("bigint").alias("row"),
    )
    return F.when(epoch.isNotNull() & number.isNotNull() & pos.isNotNull(), place)


def in_scope(events: DataFrame, db: str | None, tables: list[str] | None) -> DataFrame:
    """Only events of one database and, if given, of the listed tables."""
    if db is not None:
        events = events.where(F.col("db") == db)
    if tables is not None:
        events = events.where(F.col("table").isin(*tables))
    return events


def start_at(events: DataFrame, start: str | int = "earliest") -> DataFrame:
    """From the beginning, from now on (``latest``), or from a time in epoch milliseconds.

    Now is the time of this call, so a stream keeps it for all of its batches. Text that
    is no event has no time and stays.
    """
    if start == "earliest":
        return events
    millis = int(time.time() * 1000) if start == "latest" else int(start)
    return events.where(F.coalesce(F.col("ts_ms") >= F.lit(millis), F.lit(True)))


def after_images(events: DataFrame) -> DataFrame:
    """Insert-only extraction: the new image of every event that is no delete."""
    return events.withColumn("_action", action()).where(F.col("_action") == "upsert").drop("_action", "before")
