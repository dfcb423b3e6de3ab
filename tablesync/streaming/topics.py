"""Topics as sinks and as sources: records that count once, and upsert topics as streams.

**Out.** Kafka's sink writes at least once: a batch that died half-way is published again. Its records carry the job's label,
the batch and a number of their own in the batch, and when all are written a record on the topic of fences says how many they
are. ``finished_records`` gives a reader the records of fenced batches alone, each once, in the order of the batches
whenever their repeats were written; a batch without its fence is not there yet.

**In.** The place of a record is its partition and offset. Offsets of two partitions say nothing about each other, so
the target keeps the last one of each partition, and a change is late or not in its own.

Reading and writing Kafka itself needs Spark's connector; everything here works on records from any place.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.functions.json_rows import with_fields
from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.latest import latest_per_key
from tablesync.spec import TableSpec
from tablesync.streaming.sync import SyncOptions, bind_label, quarantine, stage, topic_records

RECORD = "key string, value string, topic string, headers array<struct<key: string, value: binary>>"
PLACE = "struct<partition:int,offset:bigint>"
MARKS = ("label", "batch", "number")


def outbox_records(records: DataFrame, label: str, batch_id: int) -> DataFrame:
    """Records ``(key, value, topic)`` of a batch with its marks as headers.

    A batch has one record for each key of a topic, so the number comes from the two and a repeat has the same ones.
    """
    number = F.sha2(F.concat_ws(" ", "topic", F.col("key").cast("string")), 256)
    marks = {"label": F.lit(label), "batch": F.lit(str(batch_id)), "number": number}
    headers = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in marks.items()])
    return records.select("key", "value", "topic", headers.alias("headers"))


def fence_records(spark: SparkSession, label: str, batch_id: int, count: int, topic: str) -> DataFrame:
    """The record that ends a batch of ``count`` records."""
    key, value = json.dumps({"label": label, "batch": batch_id}), json.dumps({"records": count})
    return spark.createDataFrame([(key, value, topic, None)], RECORD)


def finished_records(records: DataFrame, fences: DataFrame) -> DataFrame:
    """The records of finished batches, each once; ``offset`` is the batch, which orders the records of a key."""

    def mark(name: str) -> Column:
        found = F.try_element_at(F.filter("headers", lambda h: h["key"] == name), F.lit(1))
        return found["value"].cast("string").alias(name)

    marked = records.select("*", *[mark(m) for m in MARKS])
    marked = marked.withColumn("batch", F.col("batch").try_cast("bigint")).where(F.col("number").isNotNull())
    once = latest_per_key(marked, ["topic", *MARKS], -F.col("offset"))
    ended = with_fields(fences, [F.col("value").cast("string").alias("text")], F.col("key").cast("string"), "label string, batch bigint")
    ended = with_fields(ended, ["label", "batch"], F.col("text"), "records bigint").distinct()
    seen = once.groupBy("label", "batch").count()
    whole = ended.join(seen, ["label", "batch"]).where(F.col("count") >= F.col("records")).select("label", "batch")
    # One row for each batch. Were the records shuffled by batch for it, all of a batch would meet in one task.
    kept = once.join(F.broadcast(whole), ["label", "batch"], "left_semi")
    return kept.select("key", "value", "topic", F.lit(0).alias("partition"), F.col("batch").alias("offset"))


def topic_stream(
    events: DataFrame,
    specs: dict[str, TableSpec],
    kafka: dict[str, str],
    checkpoint: str,
    options: SyncOptions | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a change stream to one topic per table, with a fence on ``<label>.fences`` behind each batch."""
    options = options or SyncOptions()

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        staged = stage(batch, specs, options).sortWithinPartitions("table").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records = outbox_records(topic_records(staged, specs, options), options.label, batch_id)
            counted = records.observe(seen, F.count(F.lit(1)).alias("n"))
            counted.write.format("kafka").options(**kafka).option("includeHeaders", "true").save()
            fence = fence_records(spark, options.label, batch_id, seen.get["n"], f"{options.label}.fences")
            fence.write.format("kafka").options(**kafka).option("includeHeaders", "true").save()
        finally:
            staged.unpersist()

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def upsert_target(spark: SparkSession, root: str, spec: TableSpec, **options) -> KeyedTable:
    """The target of an upsert topic: positions are partitions and offsets, which count by partition."""
    return KeyedTable.of(spark, root, spec, seq_type=PLACE, lane="partition", **options)


def upsert_changes(records: DataFrame, spec: TableSpec) -> DataFrame:
    """The records of an upsert topic as changes of a table: a null value deletes its key.

    Columns that stand in the key are taken from it. ``_bad`` names why a record cannot be applied.
    """
    types = {c.name: c.wire_type for c in spec.columns}
    key_schema = ", ".join(f"`{k}` {types[k]}" for k in spec.keys)
    value_schema = ", ".join(f"`{n}` {t}" for n, t in types.items() if n not in spec.keys)
    place = F.struct(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"))
    keep = [place.alias("_seq"), F.col("value").cast("string").alias("_text")]
    rows = with_fields(records, keep, F.col("key").cast("string"), key_schema, corrupt="_bad_key")
    if value_schema:
        rows = with_fields(rows, [F.col(f"`{c}`") for c in rows.columns], F.col("_text"), value_schema, corrupt="_bad_value")
    else:
        rows = rows.withColumn("_bad_value", F.lit(None).cast("string"))
    no_key = F.lit(False)
    for k in spec.keys:
        no_key |= F.col(f"`{k}`").isNull()
    bad = F.when(F.col("_bad_key").isNotNull(), "unreadable key").when(no_key, "missing key")
    bad = bad.when(F.col("_bad_value").isNotNull(), "unreadable value")
    op = F.when(F.col("_text").isNull(), "delete").otherwise("upsert")
    values = [F.col(f"`{c.name}`").try_cast(c.target).alias(c.name) for c in spec.columns]
    return rows.select(*values, op.alias("_op"), "_seq", bad.alias("_bad"), F.col("_text").alias("_value"))


def upsert_stream(
    records: DataFrame,
    spec: TableSpec,
    root: str,
    checkpoint: str,
    label: str = "topic",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a target equal to an upsert topic, a stream of records ``(key, value, partition, offset)``.

    Records without a readable key or value go to quarantine, which is written before the batch's commit.
    """
    spark = records.sparkSession
    target = upsert_target(spark, root, spec)
    target.create()
    bound = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not bound:
            bound.append(bind_label(spark, root, label, checkpoint))
        changes, seen = upsert_changes(batch, spec), Observation()
        checked = changes.observe(seen, F.count_if(F.col("_bad").isNotNull()).alias("bad"))

        def before_commit() -> dict:
            bad = seen.get["bad"]
            if bad:
                quarantine(changes.where(F.col("_bad").isNotNull()), root, label, batch_id, spec.target)
            return {"quarantined": bad}

        target.apply(checked.where(F.col("_bad").isNull()).drop("_bad", "_value"), label, batch_id, before_commit)

    writer = records.writeStream.foreachBatch(handle).queryName(label).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
