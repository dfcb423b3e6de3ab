"""Outbox records with fences, and upsert topics as streams."""

import pytest
from pyspark.sql import functions as F

from tablesync.sources.kafka import start_options
from tablesync.spec import ColumnSpec, TableSpec
from tablesync.streaming import topics

SPEC = TableSpec("pets", "ods_pets", ("id",), (ColumnSpec("id", "int"), ColumnSpec("name")))
RECORD = "key binary, value binary, topic string, partition int, offset bigint"


def records_of(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, value string, topic string")


def published(*batches):
    """The batches one after another on one topic."""
    out = None
    for i, b in enumerate(batches):
        b = b.withColumn("offset", F.lit(i << 40) + F.monotonically_increasing_id())
        out = b if out is None else out.unionByName(b)
    return out


def read(records, *fences):
    fenced = fences[0]
    for f in fences[1:]:
        fenced = fenced.unionByName(f)
    return sorted(((r.key, r.value, r.offset) for r in topics.finished_records(records, fenced).collect()), key=str)


def test_repeats_and_unfinished_batches(spark):
    one = topics.outbox_records(records_of(spark, ("k1", "a", "t"), ("k2", "b", "t"), ("k1", "other topic", "u")), "job", 4)
    two = topics.outbox_records(records_of(spark, ("k1", "c", "t"), ("k2", None, "t")), "job", 5)
    ends = [topics.fence_records(spark, "job", b, n, "f") for b, n in ((4, 3), (5, 2))]
    want = sorted([("k1", "a", 4), ("k2", "b", 4), ("k1", "other topic", 4), ("k1", "c", 5), ("k2", None, 5)], key=str)
    # One and a half times, in any order, a fence twice.
    for order in ((one, two), (one.limit(1), one, two, one), (two, one, two.limit(1)), (two.limit(1), one, two)):
        assert read(published(*order), *ends, ends[0]) == want
    assert {r[2] for r in read(published(one, two), ends[0])} == {4}
    # The fence is there, but not all of its records.
    assert {r[2] for r in read(published(one, two.limit(1)), *ends)} == {4}
    other = topics.outbox_records(records_of(spark, ("k1", "z", "t")), "another job", 5)
    assert len(read(published(one, two, other), *ends)) == 5
    assert read(published(one).withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>")), *ends) == []


def put(spark, folder, *rows):
    spark.createDataFrame([(k and k.encode(), v and v.encode(), "t", p, o) for k, v, p, o in rows], RECORD).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, root):
    stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder)
    topics.upsert_stream(stream, SPEC, root, f"{root}/_checkpoints/t", trigger={"availableNow": True}).awaitTermination()
    return topics.upsert_target(spark, root, SPEC)


def test_upsert_topic_over_partitions(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    put(spark, folder, ('{"id":1}', '{"name":"late"}', 0, 50), ('{"id":2}', None, 2, 900), ('{"id":3}', '{"name":"c"}', 1, 7))
    table = run(spark, folder, root)
    table.compact(full=True)
    assert table.state().base["lanes"] == {"0": [0, 50], "1": [1, 7], "2": [2, 900]}
    # New offsets of partition 0 are below the last one of partition 2, and yet not late.
    put(spark, folder, ('{"id":4}', '{"name":"d"}', 0, 51), ('{"id":3}', None, 1, 8))
    table = run(spark, folder, root)
    assert not table.state().late_changes
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "late"), (4, "d")]
    put(spark, folder, ('{"id":1}', '{"name":"old"}', 0, 49), ('{"id":2}', '{"name":"old"}', 2, 899), ("junk", "{}", 0, 60), ('{"id":5}', "{", 0, 61))
    table = run(spark, folder, root)
    assert table.state().late_changes
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "late"), (4, "d")]
    bad = spark.read.parquet(f"{root}/_quarantine/ods_pets").collect()
    assert sorted(r._bad for r in bad) == ["unreadable key", "unreadable value"]
    table.compact(full=False)
    table.compact(full=True)
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "late"), (4, "d")]
    assert table.state().lanes == {"0": [0, 51], "1": [1, 8], "2": [2, 900]}


@pytest.mark.parametrize("start", ["earliest", "latest"])
def test_start_by_name(start):
    assert start_options(start) == {"startingOffsets": start}


def test_start_by_time():
    assert start_options("1700000000000") == {"startingTimestamp": "1700000000000", "startingOffsetsByTimestampStrategy": "latest"}


def test_records_of_a_batch_do_not_meet_in_one_task(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = topics.outbox_records(records_of(spark, ("k1", "a", "t"), ("k2", "b", "t")), "job", 4)
        found = topics.finished_records(published(one, one), topics.fence_records(spark, "job", 4, 2, "f"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        # The records are shuffled by their numbers only.
        assert "BroadcastHashJoin" in plan and "LeftSemi, BuildRight" in plan
        assert sorted(r.key for r in found.collect()) == ["k1", "k2"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
