import datetime as dt
import decimal
import time

import pytest
from pyspark.sql import functions as F

from tablesync.operators.typed import typed_rows
from tablesync.sources import change_events, kafka, ndjson, settings
from tablesync.spec import ColumnSpec, MaskRules, TableSpec

SPEC = TableSpec(
    "people",
    "ods_people",
    ("id",),
    (
        ColumnSpec("id", "decimal(20,0)", "raw", "string"),
        ColumnSpec("mobile", "string"),
        ColumnSpec("note", "string"),
        ColumnSpec("pay", "decimal(5,2)", "raw", "string"),
        ColumnSpec("born", "date", "io.debezium.time.Date", "int"),
        ColumnSpec("extra", "string"),
    ),
)


def event(op="c", after="{}", before="null", table="people", pos=1, file="bin.000001"):
    return (
        f'{{"source":{{"db":"shop","table":"{table}","ts_ms":5,"file":"{file}","pos":{pos},"row":0}},'
        f'"op":"{op}","before":{before},"after":{after}}}'
    )


def parsed(spark, *events):
    return change_events.parse_envelope(spark.createDataFrame([(e,) for e in events], "value string"))


def test_envelope_vectors(spark):
    rows = parsed(
        spark,
        event("c", '{"id":1}'),
        event("d", "null", '{"id":1}'),
        event("t"),
        "not json",
        '{"source":{"db":"shop","table":"people"},"op":"c"}',
        None,
        '{"source":{"pos":"x"},"op":"c"}',
    ).withColumn("action", change_events.action()).collect()
    assert [r.action for r in rows] == [
        "upsert", "delete", "quarantine", "quarantine", "upsert", "quarantine", "quarantine",
    ]
    assert (rows[0].before, rows[0].after) == ("{}", '{"id":1}')
    assert (rows[1].before, rows[1].after) == ('{"id":1}', "{}")
    assert rows[4].after == "{}"
    assert rows[3]._bad == "not json"


def test_typed_values(spark):
    after = (
        '{"id":12345678901234567890,"mobile":"13812345678","note":"a, b: {c} \\"d\\"","pay":"1.10",'
        '"born":18460,"extra":"{\\"k\\": [1, 2]}"}'
    )
    row = typed_rows(parsed(spark, event("c", after)), SPEC, MaskRules(("mobile",))).first()
    assert row.id == decimal.Decimal("12345678901234567890")
    assert row.mobile == "138****5678"
    assert row.note == 'a, b: {c} "d"'
    assert row.pay == decimal.Decimal("1.10")
    assert row.born == dt.date(2020, 7, 17)
    assert row.extra == '{"k": [1, 2]}'
    assert row._bad is None


def test_both_images_are_converted_alike(spark):
    spec = TableSpec("t", "t", ("d", "mobile"), (ColumnSpec("d", "date", "io.debezium.time.Date", "int"), ColumnSpec("mobile")))
    image = '{"d":18460,"mobile":"13812345678"}'
    for rules in (MaskRules(("mobile",)), MaskRules(("mobile",), mask_keys=True)):
        rows = typed_rows(parsed(spark, event("c", image), event("d", "null", image)), spec, rules).collect()
        assert rows[0].d == rows[1].d == dt.date(2020, 7, 17)
        assert rows[0].mobile == rows[1].mobile == ("138****5678" if rules.mask_keys else "13812345678")


def test_rows_that_cannot_be_applied(spark):
    rows = typed_rows(
        parsed(spark, event("c", '{"note":"x"}'), event("c", '{"id":"1","born":"x"}'), event("t", '{"id":"1"}')), SPEC
    )
    assert [r._bad for r in rows.collect()] == ["missing key", "unreadable image", "unknown operation"]


def test_overflow(spark):
    e = parsed(spark, event("c", '{"id":"1","pay":"12345.60"}'))
    assert typed_rows(e, SPEC).first()._bad == "column pay cannot hold 12345.60"
    with pytest.raises(Exception, match="column pay cannot hold 12345.60"):
        typed_rows(e, SPEC, on_overflow="fail").collect()
    assert typed_rows(e, SPEC, on_overflow="null").first().pay is None
    assert typed_rows(parsed(spark, event("c", '{"id":"1","pay":null}')), SPEC).first().pay is None


def test_a_bad_instant_is_one_bad_row(spark):
    spec = TableSpec("t", "t", ("id",), (ColumnSpec("id", "int"), ColumnSpec("at", "timestamp_ntz", "io.debezium.time.ZonedTimestamp", "string")))
    texts = ["2020-07-17T18:00:22Z", "2020-07-17T18:00:22+08:00", "2020-07-17T18:00:22", "not a time", "9999-99-99T00:00:00Z"]
    e = parsed(spark, *[event("c", f'{{"id":{i},"at":"{t}"}}', pos=i) for i, t in enumerate(texts)])
    want = [dt.datetime(2020, 7, 18, 2, 0, 22), dt.datetime(2020, 7, 17, 18, 0, 22), dt.datetime(2020, 7, 18, 2, 0, 22), None, None]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = typed_rows(e, spec).orderBy("id").collect()
        assert [r.at for r in rows] == want
        assert [r._bad for r in rows] == [None] * 3 + [f"column at cannot hold {t}" for t in texts[3:]]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.at for r in typed_rows(e, spec, on_overflow="null").orderBy("id").collect()] == want


def test_an_event_without_a_position_is_bad(spark):
    whole = event("c", '{"id":"1"}')
    rows = parsed(spark, whole, whole.replace('"file":"bin.000001",', ""), whole.replace('"pos":1,', ""), whole.replace("000001", "x"))
    assert [r._bad for r in typed_rows(rows, SPEC).collect()] == [None, "no position", "no position", "no position"]


def test_masks_and_numbers(spark):
    spec = TableSpec("t", "t", ("id",), (ColumnSpec("id", "int"), ColumnSpec("mobile", "decimal(11,0)", "raw", "string")))
    e = parsed(spark, event("c", '{"id":1,"mobile":"13812345678"}'))
    assert typed_rows(e, spec, MaskRules(("mobile",))).first().mobile is None
    assert typed_rows(e, spec, MaskRules(("mobile",), numbers="keep")).first().mobile == 13812345678
    with pytest.raises(ValueError, match="mobile of t"):
        typed_rows(e, spec, MaskRules(("mobile",), numbers="refuse"))


def test_new_columns(spark):
    e = parsed(spark, event("c", '{"id":"1","fresh":2}'))
    assert typed_rows(e, SPEC).first().id == 1
    with pytest.raises(Exception, match="people has new columns: fresh"):
        typed_rows(e, SPEC, new_columns="fail").collect()


def test_binlog_order(spark):
    rows = parsed(
        spark, event(file="bin.999999", pos=9), event(file="bin.1000000", pos=1), event(file="bin.1000000", pos=2)
    ).select(change_events.binlog_position().alias("seq"), "file", "pos")
    assert [(r.file, r.pos) for r in rows.orderBy("seq").collect()] == [
        ("bin.999999", 9), ("bin.1000000", 1), ("bin.1000000", 2),
    ]


def test_scope_and_start(spark):
    rows = parsed(spark, event(table="people"), event(table="other"))
    assert change_events.in_scope(rows, "shop", ["people"]).count() == 1
    assert change_events.in_scope(rows, "none", None).count() == 0
    assert change_events.start_at(rows, "earliest").count() == 2
    assert change_events.start_at(rows, 6).count() == 0
    assert change_events.start_at(rows, "latest").count() == 0
    now = parsed(spark, event().replace('"ts_ms":5', f'"ts_ms":{int(time.time() * 1000) + 500}'), "junk")
    late = change_events.start_at(now, "latest")
    time.sleep(1)
    assert late.count() == 2


def test_upsert_topic(spark):
    records = spark.createDataFrame(
        [
            (b'{"id":1}', b'{"v":"a"}', 0, 1), (b'{"id":1}', b'{"v":"b"}', 0, 2), (b'{"id":2}', b'{"v":"c"}', 1, 1),
            (b'{"id":2}', None, 1, 2), (b"junk", b'{"v":"d"}', 0, 3), (None, b'{"v":"e"}', 0, 4),
        ],
        "key binary, value binary, partition int, offset bigint",
    ).withColumn("topic", F.lit("t"))
    assert [tuple(r) for r in kafka.latest_records(records, "id bigint", "v string").collect()] == [(1, "b")]


def test_own_records_can_be_read(spark):
    rows = spark.createDataFrame([(1, "a", False), (1, "b", False), (2, "x", True)], "id int, v string, gone boolean")
    records = kafka.to_records(rows, ["id"], "t", deleted="gone").withColumns(
        {"partition": F.lit(0), "offset": F.monotonically_increasing_id()}
    )
    last = kafka.latest_records(records, "id int", "id int, v string")
    assert last.columns == ["id", "v"] and [tuple(r) for r in last.select("id", "v").collect()] == [(1, "b")]


def test_kafka_records(spark):
    rows = spark.createDataFrame([(1, None, False), (2, "x", True)], "id int, v string, gone boolean")
    got = [tuple(r) for r in kafka.to_records(rows, ["id"], "t", deleted="gone").orderBy("key").collect()]
    assert got == [('{"id":1}', '{"id":1,"v":null}', "t"), ('{"id":2}', None, "t")]


def test_bounded_lines(spark):
    text = "\n".join(f'{{"id": "{i}","name": "n{i}", "age": "{20 + i}"}}' for i in range(6))
    rows = ndjson.explode_lines(spark.createDataFrame([(text,)], "value string"), "value", "id string, name string, age string")
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(str(i), f"n{i}", str(20 + i)) for i in range(6)]


def test_properties(spark, tmp_path):
    (tmp_path / "masking.properties").write_text("\n#list of words\nkeywordList=mobile,phone\n  unmaskingTable = orders_test\nx=a=b\n")
    props = settings.read_properties(spark, str(tmp_path / "masking.properties"))
    assert props == {"keywordList": "mobile,phone", "unmaskingTable": "orders_test", "x": "a=b"}
    rules = settings.mask_rules(props)
    assert rules.mode_for("orders_test") == 2 and rules.mode_for("orders") == 1
    assert rules.matches("MOBILE_no") and not rules.matches("remark")
    assert not settings.mask_rules({"keywordList": ""}).matches("anything")


def test_job_row(spark):
    jobs = spark.createDataFrame(
        [("shop", "a, b,c", "l_", "2", "3000")],
        "mysqlDb string, tableList string, dorisLablePrefix string, parallelism string, checkpointInterval string",
    )
    job = settings.load_job(jobs, "shop")
    assert job.tables == ("a", "b", "c") and job.parallelism == 2
    assert job.trigger == {"processingTime": "3000 milliseconds"}
    with pytest.raises(ValueError, match="other"):
        settings.load_job(jobs, "other")
