"""Zones of keys: merges and look-ups that leave out what cannot matter give the same rows and read less."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import keyed_table
from tablesync.operators.keyed_table import KeyedTable

SCHEMA = T.StructType().add("id", "long", False).add("line", "integer", False).add("v", "string")


def changes(spark, ids, pos, gone=()):
    rows = [(i, i % 3, None if i in gone else f"v{i}-{pos}", "delete" if i in gone else "upsert", (1, pos, 0)) for i in ids]
    return spark.createDataFrame(rows, "id long, line int, v string, _op string, _seq struct<file_no:bigint,pos:bigint,row:bigint>")


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("late", [False, True])
def test_merge_and_keys_equal_the_plain_merge(spark, tmp_path, monkeypatch, late):
    monkeypatch.setattr(keyed_table, "NARROW_ROWS", 0)
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id", "line"], buckets=3)
    table.apply(changes(spark, range(-200, 1000), 5), "log", 0)
    table.compact(full=True)
    assert table.state().base["zone"] == ["-200", "999"]
    rng = random.Random(1)
    for i in range(3):
        ids = [rng.randrange(400, 480) for _ in range(30)]
        table.apply(changes(spark, sorted(set(ids)), 2 if late and i == 1 else 6 + i, gone=ids[:5]), "log", 1 + i)
    narrow = rows_of(table.read())
    assert table._narrow(table.state()) is not None and table.state().late_changes == late
    keys = spark.createDataFrame([(i, i % 3) for i in (*range(410, 430), -7, 470, 5000)], "id int, line int")
    some = rows_of(table.read_keys(keys))
    monkeypatch.setattr(keyed_table, "NARROW_SHARE", 0)
    assert table._narrow(table.state()) is None
    assert rows_of(table.read()) == narrow
    wanted = {(i, i % 3) for i in (*range(410, 430), -7, 470, 5000)}
    assert some == [r for r in narrow if r[:2] in wanted] and some
    table.compact(full=False)
    assert table.state().logs[0]["zone"] is not None and rows_of(table.read()) == narrow and rows_of(table.read_keys(keys)) == some
    table.compact(full=True)
    assert rows_of(table.read()) == narrow and rows_of(table.read_keys(keys)) == some
    assert table.read_keys(keys.limit(0)).count() == 0


def test_log_folders_that_cannot_hold_a_key_are_not_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id", "line"], buckets=2)
    for i in range(4):
        table.apply(changes(spark, range(100 * i, 100 * i + 50), i), "log", i)
    keys = spark.createDataFrame([(120, 0), (130, 1)], "id int, line int")
    found = table.read_keys(keys)
    assert rows_of(found) == [(120, 0, "v120-1"), (130, 1, "v130-1")]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) == 1


def test_text_keys(spark, tmp_path):
    schema = T.StructType().add("name", "string", False).add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["name"], buckets=2)
    rows = [(f"n{i}", i, "upsert", (1, i, 0)) for i in range(40)]
    kinds = "name string, v int, _op string, _seq struct<file_no:bigint,pos:bigint,row:bigint>"
    table.apply(spark.createDataFrame(rows[:30], kinds), "log", 0)
    table.compact(full=True)
    table.apply(spark.createDataFrame(rows[30:], kinds), "log", 1)
    assert table.read().count() == 40 and table._narrow(table.state()) is None
    assert rows_of(table.read_keys(spark.createDataFrame([("n3",), ("n35",), ("x",)], "name string"))) == [("n3", 3), ("n35", 35)]


def test_few_bytes_for_a_small_zone_and_for_few_keys(spark, tmp_path):
    def total():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id", "line"], buckets=2)
    rows = spark.range(400_000).select(
        "id", F.lit(0).alias("line"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("upsert").alias("_op"),
        F.struct(F.lit(1).cast("long").alias("file_no"), F.col("id").alias("pos"), F.lit(0).cast("long").alias("row")).alias("_seq"),
    )
    table.apply(rows, "log", 0)
    table.compact(full=True)
    # Vectored reads of local files are not counted.
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    before = total()
    table.read().write.format("noop").mode("overwrite").save()
    whole = total() - before
    before = total()
    keys = spark.range(100_000, 100_400).select("id", F.lit(0).alias("line"))
    assert table.read_keys(keys).count() == 400
    small_zone = total() - before
    # Keys from one end of the table to the other; then some that a page might hold and no row has.
    before = total()
    apart = spark.createDataFrame([(i, 0) for i in (7, 100_007, 200_007, 399_999)], "id long, line int")
    assert sorted(r.id for r in table.read_keys(apart).collect()) == [7, 100_007, 200_007, 399_999]
    few_keys = total() - before
    spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    assert whole > 10_000_000 and small_zone < 0.05 * whole and few_keys < 0.2 * whole
    assert table.read_keys(spark.createDataFrame([(-5, 0), (900_000, 0)], "id long, line int")).count() == 0
