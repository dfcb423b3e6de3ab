import json

import pytest
from pyspark.sql import functions as F

from tablesync.__main__ import main
from tablesync.operators import catalog, ddl, routing
from tablesync.operators.keyed_table import KeyedTable
from tablesync.operators.sensitive import sensitive_columns
from tablesync.plans.job import Metadata, create_missing_targets, existing_targets, prepare_job
from tablesync.plans.sql_sync import create_source_view, insert_select
from tablesync.spec import ColumnSpec, MaskRules, TableSpec

DDL = """CREATE TABLE `orders_test` (
  `id` int(11) NOT NULL AUTO_INCREMENT COMMENT 'key',
  `order_id` bigint(20) unsigned NOT NULL DEFAULT '0' COMMENT 'order',
  `occur_date` date DEFAULT NULL,
  `payed_date` datetime DEFAULT NULL,
  `actly_payed` decimal(30,12) DEFAULT NULL COMMENT 'a, b',
  `remark` varchar(255) DEFAULT NULL,
  `mobile_number` varchar(100) DEFAULT NULL,
  `id_card` varchar(100) DEFAULT NULL,
  `update_timestamp` timestamp(6) NOT NULL DEFAULT CURRENT_TIMESTAMP(6) ON UPDATE CURRENT_TIMESTAMP(6),
  PRIMARY KEY (`id`,`order_id`) USING BTREE
) ENGINE=InnoDB COMMENT='t'"""
NO_KEY = "CREATE TABLE `n` (\n  `a` int(11) DEFAULT NULL COMMENT 'PRIMARY KEY (`x`)'\n) ENGINE=InnoDB"
ONE = "CREATE TABLE `o` (\n  `a` varchar(3) NOT NULL,\n  PRIMARY KEY (`a`(2))\n) ENGINE=InnoDB"


@pytest.fixture
def ddls(spark):
    return spark.createDataFrame([("orders_test", DDL), ("n", NO_KEY), ("o", ONE)], "table_name string, ddl string")


def test_columns_and_keys(ddls):
    rows = ddl.ddl_columns(ddls).orderBy("table_name", "idx").collect()
    orders = [r for r in rows if r.table_name == "orders_test"]
    assert [r.idx for r in orders] == list(range(9))
    assert [r.column_name for r in orders][6:8] == ["mobile_number", "id_card"]
    assert [r.unsigned for r in orders] == [False, True] + [False] * 7
    assert orders[4].comment == "a, b" and orders[4].spark_type == "decimal(27,8)"
    keys = {r.table_name: (r["keys"], r.table_comment) for r in ddl.ddl_primary_keys(ddls).collect()}
    assert keys == {"orders_test": (["id", "order_id"], "t"), "n": ([], ""), "o": (["a"], "")}
    assert [r.table_name for r in ddl.tables_without_key(ddls).collect()] == ["n"]


def test_sensitive_columns(ddls):
    rules = MaskRules(("mobile", "id_card"), ("orders_test",))
    found = sensitive_columns(ddl.ddl_columns(ddls), rules).orderBy("idx").collect()
    assert [(r.idx, r.column_name, r.mode) for r in found] == [(6, "mobile_number", 2), (7, "id_card", 2)]
    assert sensitive_columns(ddl.ddl_columns(ddls), MaskRules()).count() == 0


def test_specs(ddls):
    with pytest.raises(ValueError, match="n has no primary key"):
        ddl.table_specs(ddls)
    specs = ddl.table_specs(ddls.where("table_name <> 'n'"), {"orders_test": "ods_orders"})
    spec = specs["orders_test"]
    assert (spec.target, spec.keys) == ("ods_orders", ("id", "order_id"))
    schema = spec.target_schema()
    assert schema["order_id"].dataType.simpleString() == "decimal(20,0)" and not schema["order_id"].nullable
    assert schema["id"].metadata == {"comment": "key"}


def test_target_definition_runs(spark, ddls):
    spark.sql("CREATE DATABASE IF NOT EXISTS ods_test")
    text = {r.table_name: r.ddl for r in ddl.target_ddl(ddls, buckets=4, db="ods_test").collect()}
    assert set(text) == {"orders_test", "o"}
    spark.sql(text["orders_test"])
    assert dict(spark.table("ods_test.orders_test").dtypes)["actly_payed"] == "decimal(27,8)"
    comments = {c.name: c.description for c in spark.catalog.listColumns("ods_test.orders_test")}
    assert comments["actly_payed"] == "a, b"
    spark.sql("DROP DATABASE ods_test CASCADE")


def lookup_tables(spark):
    imports = spark.createDataFrame(
        [
            (7, "c1", "shop", "a_b", "src_shop_a_b"), (3, "c2", "other", "a_b", "src_other_a_b"),
            (5, "c1", "shop", "axb", "src_shop_axb"), (9, "c3", "shop", "a_b", "src_later_a_b"),
            (1, "c1", "shop", "a_b", "src_shop_axb"), (2, "c9", "shop", "lone", "src_lone"),
        ],
        "id int, connection_id string, db_name string, table_name string, hive_table string",
    )
    connections = spark.createDataFrame(
        [("c1", "h1", 3306, "useSSL=false"), ("c2", "h2", 3307, None), ("c3", "h3", 3308, "")],
        "connection_id string, hostname string, port int, jdbc_extend string",
    )
    return imports, connections


def test_lookup_traps(spark):
    wanted = spark.createDataFrame([("shop", t) for t in ("a_b", "lone", "gone")], "db_name string, table_name string")
    found = {r.table_name: r for r in catalog.catalog_lookup(wanted, *lookup_tables(spark)).collect()}
    assert found["a_b"].target == "ods_shop_a_b" and found["a_b"].url == "jdbc:mysql://h1:3306/shop?useSSL=false"
    assert found["lone"].status == "no connection" and found["gone"].status == "no import entry"


def test_prepare_and_create(spark, tmp_path):
    jobs = spark.createDataFrame(
        [("shop", "a_b,axb", "l", "2", "1000")],
        "mysqlDb string, tableList string, dorisLablePrefix string, parallelism string, checkpointInterval string",
    )
    definitions = spark.createDataFrame(
        [(t, DDL.replace("orders_test", t)) for t in ("a_b", "axb", "unused")], "table_name string, ddl string"
    )
    imports, connections = lookup_tables(spark)
    job = prepare_job(spark, Metadata(jobs, imports, connections, definitions), "shop")
    assert list(job.specs) == ["a_b", "axb"] and job.filters == {"a_b": "update_timestamp", "axb": "update_timestamp"}
    root = str(tmp_path)
    assert existing_targets(spark, root).count() == 0
    assert create_missing_targets(spark, job.specs, root) == ["ods_shop_a_b", "ods_shop_axb"]
    assert create_missing_targets(spark, job.specs, root) == []
    assert {r.target for r in existing_targets(spark, root).collect()} == {"ods_shop_a_b", "ods_shop_axb"}
    broken = jobs.withColumn("tableList", F.lit("a_b,gone"))
    with pytest.raises(ValueError, match="gone"):
        prepare_job(spark, Metadata(broken, imports, connections, definitions), "shop")


def test_insert_select(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, other string")
    view = create_source_view(rows, "test_source")
    target = KeyedTable.of(
        spark, str(tmp_path), TableSpec("t", "t", ("id",), (ColumnSpec("id", "int"), ColumnSpec("name")))
    )
    insert_select(spark, target, f"SELECT name, id FROM {view}", "sql", 0)
    assert sorted(tuple(r) for r in target.read().collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="name"):
        insert_select(spark, target, f"SELECT id FROM {view}", "sql", 1)


def write_settings(folder):
    def put(name, *rows):
        (folder / name).mkdir(parents=True)
        (folder / name / "rows.json").write_text("\n".join(json.dumps(r) for r in rows))

    put("sync_jobs", dict(mysqlDb="shop", tableList="people", dorisLablePrefix="l1", parallelism="2", checkpointInterval="500"))
    put("meta_import", dict(id=1, connection_id="c", db_name="shop", table_name="people", hive_table="src_shop_people"))
    put("meta_connections", dict(connection_id="c", hostname="h", port=3306, jdbc_extend="useSSL=false"))
    ddl_text = "CREATE TABLE `people` (\n  `id` int(11) NOT NULL,\n  `mobile` varchar(20),\n  `update_time` datetime,\n  `day` date,\n  PRIMARY KEY (`id`)\n)"
    put("definitions", dict(table_name="people", ddl=ddl_text))
    (folder / "masking.properties").write_text("keywordList=mobile\nunmaskingTable=\n")


def test_entry_points(spark, tmp_path, monkeypatch):
    """Stream a file, then back-fill from a database, through the command line."""
    write_settings(tmp_path / "settings")
    event = {
        "source": {"db": "shop", "table": "people", "ts_ms": 1, "file": "bin.000001", "pos": 4, "row": 0},
        "op": "c", "before": None,
        "after": {"id": 1, "mobile": "13812345678", "update_time": 1595008822123, "day": 18460},
    }
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps(event) + "\n")
    common = ["--settings", f"{tmp_path}/settings", "--root", f"{tmp_path}/root"]
    main(["stream", "--db", "shop", "--jobName", "j", "--maskMode", "mask", "--events", f"{tmp_path}/in", "--start", "earliest", "--available-now", *common])

    url = "jdbc:derby:memory:entry;create=true"
    rows = spark.sql(
        "SELECT 2 id, '13900001111' mobile, timestamp_ntz'2024-01-01 00:00:00' update_time, date'2024-01-01' day "
        "UNION ALL SELECT 3, 'x', timestamp_ntz'2020-01-01 00:00:00', date'2020-01-01'"
    )
    rows.coalesce(1).write.format("jdbc").options(url=url, dbtable="people").save()
    main(["batch", "mask", "shop", "2023-01-01", "00:00:00", "--jdbc-option", f"url={url}", *common])

    spec = TableSpec(
        "people", "ods_shop_people", ("id",),
        (ColumnSpec("id", "int"), ColumnSpec("mobile"), ColumnSpec("update_time", "timestamp_ntz"), ColumnSpec("day", "date")),
    )
    got = KeyedTable.of(spark, f"{tmp_path}/root", spec).read().orderBy("id").collect()
    assert [(r.id, r.mobile, str(r.update_time), str(r.day)) for r in got] == [
        (1, "138****5678", "2020-07-17 18:00:22.123000", "2020-07-17"),
        (2, "139****1111", "2024-01-01 00:00:00", "2024-01-01"),
    ]


def test_a_catalog_goes_to_the_events(spark):
    """Events are not shuffled by their table, of which one may have most."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "table string, n int")
        catalog = spark.createDataFrame([("a", "ods_a"), ("c", "ods_c"), (None, "none")], "table string, target string")
        routed, lost = routing.route(events, catalog), routing.unknown_tables(events, catalog)
        for found in (routed, lost):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted((r.n, r.target) for r in routed.collect()) == [(1, "ods_a"), (2, "ods_a")]
        assert sorted(r.n for r in lost.collect()) == [3, 4]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
