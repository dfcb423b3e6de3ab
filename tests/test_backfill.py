import uuid

import pytest
from pyspark.sql import functions as F

from tablesync.operators import backfill
from tablesync.operators.audit import read_audit
from tablesync.operators.ddl import ddl_columns
from tablesync.operators.keyed_table import KeyedTable
from tablesync.plans.batch_sync import BackfillError, batch_sync
from tablesync.plans.sql_sync import insert_select
from tablesync.sources import jdbc
from tablesync.spec import ColumnSpec, MaskRules, TableSpec

RULES = [
    ("last_modify datetime, update_time datetime", "last_modify", "last_modify>='T'"),
    ("id int, name varchar(9)", "full", "1=1"),
    ("id int, birth date", "full", "1=1"),
    ("update_timestamp datetime, update_time datetime", "update_timestamp", "update_timestamp>='T'"),
    ("update_time datetime", "update_time", "update_time>='T'"),
    ("update_date datetime", "update_date", "update_date>='T'"),
    ("operator_time datetime", "operator_time", "operator_time>='T'"),
    ("occur_time datetime, in_bill_time datetime", "either", "occur_time>='T' or in_bill_time>='T'"),
    ("occur_time datetime", "occur_time", "occur_time>='T'"),
    ("in_bill_time datetime", "in_bill_time", "in_bill_time>='T'"),
    ("occur_time timestamp", "full", "1=1"),
    ("created datetime", "unregistered", None),
]


def test_rules(spark):
    ddls = []
    for i, (columns, _, _) in enumerate(RULES):
        lines = "".join(f"  `{c.split()[0]}` {c.split()[1]},\n" for c in columns.split(", "))
        ddls.append((str(i), f"CREATE TABLE `t` (\n{lines}  PRIMARY KEY (`id`)\n)"))
    frame = spark.createDataFrame(ddls, "table_name string, ddl string")
    by_name = backfill.choose_filters(ddl_columns(frame))
    got = {r.table_name: (r.rule, r.p) for r in by_name.withColumn("p", backfill.predicate_text(F.col("rule"), "T")).collect()}
    assert got == {str(i): (rule, text) for i, (_, rule, text) in enumerate(RULES)}


def test_comments_count_only_in_text_mode(spark):
    ddl = "CREATE TABLE `t` (\n  `id` int COMMENT 'see update_time, a date',\n  PRIMARY KEY (`id`)\n)"
    frame = spark.createDataFrame([("t", ddl)], "table_name string, ddl string")
    assert backfill.choose_filters(ddl_columns(frame)).first().rule == "full"
    assert backfill.choose_filters_by_text(frame).first().rule == "update_time"


def test_the_filter_is_pushed_to_the_scan(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_orderdate", "update_time")
    plan = backfill.rows_since(rows, "update_time", "2000-01-01 00:00:00").select("o_orderkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_totalprice" not in text
    with pytest.raises(ValueError):
        backfill.rows_since(rows, "unregistered", "2000-01-01")


SPEC = TableSpec(
    "people", "ods_people", ("id",),
    (ColumnSpec("id", "int"), ColumnSpec("mobile"), ColumnSpec("update_time", "timestamp_ntz")),
)


def people(spark, *rows):
    return spark.createDataFrame(rows, "id int, mobile string, t string").select(
        "id", "mobile", F.col("t").cast("timestamp_ntz").alias("update_time")
    )


def streamed(spark, root, *rows):
    changes = spark.createDataFrame(
        rows, "id int, mobile string, _op string, _seq struct<file_no:bigint,pos:bigint,row:bigint>"
    ).withColumn("update_time", F.lit(None).cast("timestamp_ntz"))
    KeyedTable.of(spark, root, SPEC).apply(changes, "stream", rows[0][3][1])


def test_back_fill_meets_the_stream(spark, tmp_path):
    root = str(tmp_path)
    streamed(spark, root, (1, "old", "upsert", (1, 10, 0)), (2, "keep", "upsert", (1, 11, 0)))
    rows = people(spark, (1, "13812345678", "2024-01-02"), (2, "13812345678", "2023-01-01"), (3, "gap", "2024-01-03"))
    audit = batch_sync(
        spark, {"people": SPEC}, {"people": "update_time"}, lambda t: rows, "2024-01-01 00:00:00", root, MaskRules(("mobile",))
    )
    assert [(r.upserts, r.status) for r in audit.collect()] == [(2, "ok")]
    live = {r.id: r.mobile for r in KeyedTable.of(spark, root, SPEC).read().collect()}
    assert live == {1: "138****5678", 2: "keep", 3: "gap"}
    # A change that was streamed after the scan's position wins over the scanned row, in any order.
    streamed(spark, root, (3, None, "delete", (1, 30, 0)))
    batch_sync(spark, {"people": SPEC}, {"people": "full"}, lambda t: rows, "", root, position={"file_no": 1, "pos": 20})
    assert {r.id for r in KeyedTable.of(spark, root, SPEC).read().collect()} == {1, 2}


def test_errors_stop_or_are_recorded(spark, tmp_path):
    other = TableSpec("other", "ods_other", ("id",), SPEC.columns)
    third = TableSpec("third", "ods_third", ("id",), SPEC.columns)
    specs = {"people": SPEC, "other": other, "third": third}
    filters = {"people": "full", "other": "unregistered", "third": "full"}
    rows = people(spark, (1, "a", "2024-01-02"))
    with pytest.raises(BackfillError, match="other") as stopped:
        batch_sync(spark, specs, filters, lambda t: rows, "", str(tmp_path / "a"))
    assert stopped.value.done == ["people"]
    assert {r.table: r.status for r in read_audit(spark, str(tmp_path / "a")).collect()} == {"people": "ok", "other": "failed"}
    audit = batch_sync(spark, specs, filters, lambda t: rows, "", str(tmp_path / "b"), on_error="continue", parallel_tables=2)
    assert {r.table: r.status for r in audit.collect()} == {"people": "ok", "other": "failed", "third": "ok"}


def test_jdbc_scan(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = spark.range(100).select(
        F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.expr("timestamp_ntz'2024-01-01 00:00:00'")).alias("update_time"),
    )
    rows.coalesce(1).write.format("jdbc").options(url=url, dbtable="people").save()
    scan = jdbc.read_jdbc(spark, url, "people", partition_column="id", partitions=4)
    assert scan.rdd.getNumPartitions() == 4 and scan.count() == 100
    since = backfill.rows_since(scan, "update_time", "2024-03-01 00:00:00").select("id")
    assert "PushedFilters: [*IsNotNull(update_time), *GreaterThanOrEqual(update_time" in since._jdf.queryExecution().executedPlan().toString()
    assert since.count() == 40


def test_jdbc_parts_under_the_condition(spark):
    """Ranges between the bounds of the rows asked for, and parts by a hash for keys that are no single number."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = spark.range(1000).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 10).cast("int").alias("line"), F.concat(F.lit("n"), "id").alias("name"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.expr("timestamp_ntz'2024-01-01 00:00:00'")).alias("update_time"),
    )
    rows.coalesce(1).write.format("jdbc").options(url=url, dbtable="lines").save()
    since = "2024-02-05 00:00:00"
    condition = backfill.predicate_sql("update_time", since, lambda c: jdbc.quoted(spark, url, c))
    by_hash = 'mod("id" * 31 + "line" * 2, 1000)'
    for how in ({"partition_column": "id"}, {"split_by": by_hash}):
        scan = jdbc.read_jdbc(spark, url, "lines", partitions=4, condition=condition, **how)
        parts = [len(p) for p in backfill.rows_since(scan, "update_time", since).rdd.glom().collect()]
        assert sum(parts) == 160 and len(parts) == 4 and max(parts) <= 2 * min(parts)
    assert jdbc.key_hash(["`a`", "`b`"]) == "crc32(concat_ws('|', `a`, `b`))"
    assert backfill.predicate_sql("full", since) is None


def test_every_back_fill_wins_over_the_one_before(spark, tmp_path):
    for way, compact in enumerate(((), (True,), (False, False), (True, False, True))):
        root = str(tmp_path / str(way))
        streamed(spark, root, (1, "streamed", "upsert", (1, 10, 0)))
        table = KeyedTable.of(spark, root, SPEC)
        for i in range(3):
            rows = people(spark, *[(k, f"run{i}", "2024-01-02") for k in range(5)])
            batch_sync(spark, {"people": SPEC}, {"people": "full"}, lambda t, rows=rows: rows, "", root)
            assert {r.mobile for r in table.read().collect()} == {f"run{i}"}
            if i < len(compact):
                table.compact(full=compact[i])
        assert {r.mobile for r in table.read().collect()} == {"run2"}


def test_every_insert_wins_over_the_one_before(spark, tmp_path):
    streamed(spark, str(tmp_path), (1, "streamed", "upsert", (1, 10, 0)))
    table = KeyedTable.of(spark, str(tmp_path), SPEC)
    for i in range(3):
        people(spark, (1, f"run{i}", "2024-01-02"), (2, f"run{i}", "2024-01-02")).createOrReplaceTempView("people_now")
        insert_select(spark, table, "SELECT * FROM people_now", "sql", i)
        assert {r.mobile for r in table.read().collect()} == {f"run{i}"}


def test_a_key_that_a_scan_meets_twice_is_one_row(spark, tmp_path):
    rows = people(spark, (1, "a", "2024-01-02"), (1, "b", "2024-01-02"), (2, "c", "2024-01-02"))
    audit = batch_sync(spark, {"people": SPEC}, {"people": "full"}, lambda t: rows, "", str(tmp_path)).first()
    assert audit.upserts == 2 and KeyedTable.of(spark, str(tmp_path), SPEC).read().count() == 2


def test_an_error_without_a_text_is_recorded(spark, tmp_path):
    def scan(name):
        raise KeyError()

    audit = batch_sync(spark, {"people": SPEC}, {"people": "full"}, scan, "", str(tmp_path), on_error="continue")
    assert [(r.status, r.error) for r in audit.collect()] == [("failed", "KeyError")]


def test_url_time_zone():
    plain = jdbc.mysql_url("h", 3306, "d", "useSSL=false")
    assert jdbc.with_server_time_zone(plain) == "jdbc:mysql://h:3306/d?useSSL=false&serverTimezone=GMT%2B8"
    assert jdbc.with_server_time_zone("jdbc:mysql://h/d") == "jdbc:mysql://h/d?serverTimezone=GMT%2B8"
    for named in jdbc.CHINA_ZONE_PARAMS:
        assert jdbc.with_server_time_zone(f"{plain}&{named}") == f"{plain}&{named}"
