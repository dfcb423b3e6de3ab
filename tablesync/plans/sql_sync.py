"""``INSERT INTO target SELECT ...`` over a change source, once or for as long as it changes.

``insert_select`` inserts what a select gives. ``insert_changes`` keeps a target equal to a select over a table
that changes: each event has an image of the row before and one after it, and the select is asked for both. A row
that passes afterwards is an upsert; one that passed before and does not pass afterwards, or passes under
another key, is a delete at the event's position.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.typed import typed_rows
from tablesync.spec import TableSpec
from tablesync.streaming.sync import SyncOptions, bind_label, first_start, placed_batch

OLD, NEW = "old", "new"


def create_source_view(rows: DataFrame, table: str) -> str:
    """Typed change rows as a view ``cdc_<table>`` for SQL."""
    name = f"cdc_{table}"
    rows.createOrReplaceTempView(name)
    return name


def insert_select(
    spark: SparkSession, target: KeyedTable, select: str, label: str, batch_id: int, position: dict | None = None
) -> dict:
    """Run ``select`` and upsert its rows; columns are matched by name.

    A select that carries ``_op`` and ``_seq`` through also deletes, in log order.
    One that does not inserts all its rows at ``position``, or at the last one the
    target has seen, so that the last insert wins. A condition that rows may cease to meet needs ``insert_changes``.
    """
    rows = spark.sql(select)
    if "_op" not in rows.columns:
        rows = rows.withColumn("_op", F.lit("upsert"))
    if "_seq" not in rows.columns:
        rows = rows.withColumn("_seq", target.position(position))
    _all_columns(rows, target)
    return target.apply(rows, label, batch_id)


def _all_columns(rows: DataFrame, target: KeyedTable) -> None:
    missing = [n for n in target.schema.names if n not in rows.columns]
    if missing:
        raise ValueError(f"the select gives no column for {missing}")


def change_images(events: DataFrame, spec: TableSpec, options: SyncOptions | None = None) -> DataFrame:
    """The table's columns of every image with ``_op``, ``_seq``, ``_bad``, ``_image`` (old or new) and ``_whole``.

    ``_whole`` says whether an old image has all columns; a source may log the key alone.
    """
    options = options or SyncOptions()
    mine = events.where((F.col("table") == spec.table) & F.col("op").isin("c", "u", "r", "d"))
    names = F.array(*[F.lit(n) for n in spec.column_names])
    whole = F.size(F.array_except(names, F.coalesce(F.json_object_keys("before"), F.array().cast("array<string>")))) == 0
    # Both images are read as a delete's is, from ``before``, so they get the same conversions and masks.
    sides = F.array(
        F.struct(F.lit(NEW).alias("_image"), F.lit(True).alias("_whole"), F.when(F.col("op") != "d", F.col("after")).alias("_json")),
        F.struct(F.lit(OLD).alias("_image"), whole.alias("_whole"), F.when(F.col("op").isin("u", "d"), F.col("before")).alias("_json")),
    )
    images = mine.select("*", F.inline(sides)).where(F.col("_json").isNotNull())
    images = images.withColumns({"op": F.lit("d"), "before": F.col("_json"), "after": F.lit("{}")})
    kept = ["_image", "_whole"]
    typed = typed_rows(
        images, spec, options.rules, options.time_zone, options.seq, options.new_columns, options.on_overflow, kept
    )
    return typed.withColumn("_op", F.when(F.col("_image") == NEW, "upsert").otherwise("delete"))


def insert_changes(
    spark: SparkSession,
    target: KeyedTable,
    select: str,
    images: DataFrame,
    table: str,
    label: str,
    batch_id: int,
    truncated_at: dict | None = None,
) -> dict:
    """Bring one batch of changes (see ``change_images``) of ``table`` into a target that holds ``select``.

    ``select`` reads the view ``cdc_<table>`` row by row: columns, expressions, a condition, joins with tables
    that do not change; no grouping. Where an old image is not whole, the target's key columns must be
    columns of the table by the same name; its rows are then deleted unless they pass afterwards.
    """
    good = images.where(F.col("_bad").isNull()).drop("_bad")

    def asked(image: str) -> DataFrame:
        create_source_view(good.where(F.col("_image") == image).drop("_image", "_whole"), table)
        rows = _with_position(spark, select)
        _all_columns(rows, target)
        return rows.select(*[F.col(f"`{n}`") for n in target.schema.names], "_seq")

    after, before = asked(NEW), asked(OLD)
    keys = [*target.keys, "_seq"]
    gone = [before.select(*keys)]
    partial = good.where((F.col("_image") == OLD) & ~F.col("_whole"))
    if set(target.keys) <= set(good.columns):
        gone.append(partial.select(*keys))
    else:
        message = f"an old image of {table} lacks columns, and {target.keys} are not all among its own"
        gone.append(partial.select(*[F.raise_error(F.lit(message)).cast(before.schema[k].dataType).alias(k) for k in keys]))
    left = reduce(DataFrame.union, gone).distinct().join(after.select(*keys), keys, "left_anti")
    left = left.withColumn("_op", F.lit("delete"))
    changes = after.withColumn("_op", F.lit("upsert")).unionByName(left, allowMissingColumns=True)
    return target.apply(changes, label, batch_id, truncated_at=truncated_at)


def _with_position(spark: SparkSession, select: str) -> DataFrame:
    """The select's rows with the position of their event, which a plain select need not name."""
    rows = spark.sql(select)
    if "_seq" in rows.columns:
        return rows
    carried, times = re.subn(r"^\s*select\s+(?!distinct\b)", "SELECT _seq, ", select, count=1, flags=re.IGNORECASE)
    if not times:
        raise ValueError("the select must carry _seq")
    return spark.sql(carried)


def insert_stream(
    events: DataFrame,
    spec: TableSpec,
    target: KeyedTable,
    select: str,
    checkpoint: str,
    root: str,
    options: SyncOptions | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a target equal to a select over a table whose change events come as a stream with a text column ``value``.

    ``root`` holds the job's notes: its first start, its servers, the checkpoint its label belongs to.
    """
    options, spark = options or SyncOptions(label="insert"), events.sparkSession
    options = first_start(spark, root, options)
    target.create()
    bound = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not bound:
            bound.append(bind_label(spark, root, options.label, checkpoint))
        with placed_batch(batch, {spec.table: spec}, root, options) as placed:
            images = change_images(placed.rows, spec, placed.options)
            at = placed.truncated.get(spec.table)
            insert_changes(batch.sparkSession, target, select, images, spec.table, options.label, batch_id, at)

    writer = events.writeStream.foreachBatch(handle).queryName(options.label).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def insert_available(events: DataFrame, *args, **options) -> None:
    """A bounded run of ``insert_stream``: take everything the source has now, then stop."""
    insert_stream(events, *args, **options, trigger={"availableNow": True}).awaitTermination()

