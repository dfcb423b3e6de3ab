"""Kafka records: options, decoding, keyed compaction and encoding.

Reading needs Spark's Kafka connector on the classpath. Decoding and encoding
are plain functions over ``key, value, topic, partition, offset``, so they work
on records from any place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.json_rows import JSON_FORMATS, with_fields
from tablesync.operators.latest import latest_per_key


def kafka_options(servers: str, topics: list[str], start: str = "earliest", group_prefix: str | None = None) -> dict:
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start}
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options


def start_options(start: str | int) -> dict:
    """Where a topic is read from: ``earliest``, ``latest`` or the first record of a time in epoch milliseconds."""
    if start in ("earliest", "latest"):
        return {"startingOffsets": start}
    return {"startingTimestamp": str(int(start)), "startingOffsetsByTimestampStrategy": "latest"}


def read_kafka(spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **options) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**{**kafka_options(servers, topics), **options}).load()


def decode_values(records: DataFrame, schema: str) -> DataFrame:
    """JSON values as columns; ``_bad`` keeps the text that is not JSON of this shape."""
    place = [c for c in ("topic", "partition", "offset") if c in records.columns]
    return with_fields(records, place, F.col("value").cast("string"), schema, corrupt="_bad")


def latest_records(records: DataFrame, key_schema: str, value_schema: str, keep_deleted: bool = False) -> DataFrame:
    """Upsert topic: the last value of every key; a null value deletes the key.

    Records whose key is no JSON of ``key_schema`` are ignored. All records of a
    key are in one partition, so the offset orders them. A column that stands in
    the key and in the value, as in the records of ``to_records``, is taken from the key.
    """
    keyed = with_fields(
        records, ["topic", "partition", "offset", "value"], F.col("key").cast("string"), key_schema, corrupt="_bad"
    )
    names = [c for c in keyed.columns if c not in ("topic", "partition", "offset", "value", "_bad")]
    has_key = F.col("_bad").isNull() & F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    last = latest_per_key(keyed.where(has_key).drop("_bad"), names, F.struct("offset", "partition"))
    if not keep_deleted:
        last = last.where(F.col("value").isNotNull())
    keys = [F.col(f"`{n}`").alias(f"_key{i}") for i, n in enumerate(names)]
    rows = with_fields(last, keys, F.col("value").cast("string"), value_schema)
    rest = [c for c in rows.columns[len(names) :] if c not in names]
    return rows.select(*[F.col(f"_key{i}").alias(n) for i, n in enumerate(names)], *[F.col(f"`{c}`") for c in rest])


def to_records(rows: DataFrame, keys: list[str], topic: str, deleted: str | None = None) -> DataFrame:
    """``(key, value, topic)`` for the Kafka sink; rows flagged ``deleted`` get a null value."""
    data = [c for c in rows.columns if c != deleted]
    value = F.to_json(F.struct(*data), JSON_FORMATS)
    if deleted:
        value = F.when(~F.col(deleted), value)
    return rows.select(F.to_json(F.struct(*keys), JSON_FORMATS).alias("key"), value.alias("value"), F.lit(topic).alias("topic"))
