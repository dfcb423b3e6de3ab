"""One write for the changes of all tables of a batch.

A batch's changes have one form whatever their table: the table's number in the batch, the key as text, the position and the
typed, masked row as VARIANT. They are reduced to the last one of each key and written by one job into a folder beside the
targets, ``<root>/_log/<batch>/part=<number>``; a second job counts what each part holds, and each target gets a commit that
names its part. So the jobs of a batch do not grow with the number of tables. Tasks hardly do in a small batch: a table's
share of the batch says how many read it, and the kept batch is ordered by table. Each table's tasks read all of the kept
batch between them, so a large batch has more of them for each table, however few of its events the table has.

Rows that cannot be applied are written beside the others, and from there to quarantine before the commits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.json_rows import JSON_FORMATS
from tablesync.operators.keyed_table import IMAGES, RETAIN_SECONDS, KeyedTable, image_field, json_position
from tablesync.operators.latest import latest_per_key
from tablesync.sources.files import delete_folder, list_files, list_with_age
from tablesync.spec import TableSpec

FOLDER = "_log"
# Rows of the kept batch that a task reads, as far as the batch's partitions allow. Effort only.
READ_ROWS = 1 << 20


@dataclass
class Part:
    """What a batch brought for one table; ``folder`` is as the target's commits name it, None without rows."""

    folder: str | None = None
    upserts: int = 0
    deletes: int = 0
    bad: int = 0
    first_seq: dict | None = None
    last_seq: dict | None = None


def image_form(typed: DataFrame, spec: TableSpec, number: int, seq_type: T.DataType, write: int) -> DataFrame:
    """Typed changes of one table in the form that all tables share. A delete keeps only its key."""
    gone = F.col("_op") == "delete"
    values = {n: F.col(f"`{n}`") if n in spec.keys else F.when(~gone, F.col(f"`{n}`")) for n in spec.column_names}
    fields = [v.alias(image_field(n)) for n, v in values.items()]
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in spec.keys]), JSON_FORMATS)
    # A row that cannot be applied is kept whatever its key.
    key = F.when(F.col("_bad").isNull(), key).otherwise(F.concat(F.lit("bad "), F.monotonically_increasing_id()))
    return typed.select(
        F.lit(number).alias("part"),
        key.alias("_key"),
        F.col("_seq").cast(seq_type).alias("_seq"),
        F.lit(write).cast("long").alias("_write"),
        gone.alias("_deleted"),
        "_bad",
        F.to_variant_object(F.struct(*fields)).alias("_image"),
    )


def read_tasks(events: int, total: int, kept: int, tasks: int) -> int:
    """How many tasks read the kept batch of ``kept`` rows for a table with so many of its ``total`` changes."""
    return max(1, -(-tasks * events // total), -(-kept // READ_ROWS))


def write_parts(
    typed: Callable[[TableSpec], DataFrame],
    tables: dict[str, KeyedTable],
    specs: dict[str, TableSpec],
    events: dict[str, int],
    root: str,
    label: str,
    batch_id: int,
    write: int,
    kept: int,
) -> dict[str, Part]:
    """Write the changes of the tables in ``events``, the number of each one's events, and say what each has got.

    ``typed`` gives a table's changes, with ``_op``, ``_seq`` and ``_bad``, from the kept batch, which has ``kept`` rows.
    """
    names, total = list(events), max(1, sum(events.values()))
    if not names:
        return {}
    spark = tables[names[0]].spark
    branches = []
    for number, name in enumerate(names):
        table = tables[name]
        rows = image_form(typed(specs[name]), specs[name], number, table.seq_type, write)
        branches.append((rows, events[name]))
    tasks = spark.sparkContext.defaultParallelism
    shares = [rows.coalesce(read_tasks(n, total, kept, tasks)) for rows, n in branches]
    rows = latest_per_key(reduce(DataFrame.union, shares), ["part", "_key"], "_seq").drop("_key")
    batch = f"{re.sub(r'[^A-Za-z0-9_.-]', '_', label)}-{batch_id}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/{FOLDER}/{batch}"
    # Few files for each part, and several for a part with much of the batch.
    rows.hint("rebalance", "part").write.partitionBy("part").parquet(folder)

    seq_type = tables[names[0]].seq_type
    schema = T.StructType().add("_seq", seq_type).add("_deleted", "boolean").add("_bad", "string").add("part", "integer")
    good = F.col("_bad").isNull()
    seen = spark.read.schema(schema).parquet(folder).groupBy("part").agg(
        F.count_if(good & ~F.col("_deleted")).alias("upserts"),
        F.count_if(good & F.col("_deleted")).alias("deletes"),
        F.count_if(~good).alias("bad"),
        F.min(F.when(good, F.col("_seq"))).alias("first_seq"),
        F.max(F.when(good, F.col("_seq"))).alias("last_seq"),
    )
    parts = {name: Part() for name in names}
    for r in seen.collect():
        place = f"../{FOLDER}/{batch}/part={r.part}"
        parts[names[r.part]] = Part(place, r.upserts, r.deletes, r.bad, json_position(r.first_seq), json_position(r.last_seq))
    return parts


def vacuum_parts(spark: SparkSession, root: str, retain_seconds: float = RETAIN_SECONDS) -> list[str]:
    """Delete the batches that no target beside them needs, once they are old enough for no reader or writer to use them."""
    old = [path for path, age in list_with_age(spark, f"{root}/{FOLDER}/*") if age >= retain_seconds]
    if not old:
        return []
    used = set()
    for path in list_files(spark, f"{root}/*/commits"):
        state = KeyedTable(spark, path.rsplit("/", 1)[0], T.StructType(), []).state()
        used |= {log["folder"].split("/")[2] for log in state.logs if log.get("form") == IMAGES}
    gone = [path for path in old if path.rsplit("/", 1)[1] not in used]
    for path in gone:
        delete_folder(spark, path)
    return sorted(path.rsplit("/", 1)[1] for path in gone)
