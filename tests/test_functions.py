import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablesync.functions import keywords, mysql_types, temporal
from tablesync.functions.masking import mask_pii

MASKS = [
    # input, mode 1, mode 2
    ("11010519491231002X", "110105194912******", "110105194912******"),
    ("110105 19491231 002X", "110105194912******", "110105194912******"),
    ("13812345678", "138****5678", "13812345678"),
    ("+86 138-1234-5678", "138****5678", "+86 138-1234-5678"),
    ("8613812345678", "138****5678", "8613812345678"),
    ("010-12345678", "010-1****5678", "010-12345678"),
    (" 010-12345678 ", "010-1****5678", " 010-12345678 "),
    ("01012345678", "01012****678", "01012345678"),
    ("0755 1234567", "0755 ****4567", "0755 1234567"),
    ("021-11111111", "021-********11", "021-11111111"),
    ("13812345678\n", "13812345678\n", "13812345678\n"),
    ("12345", "12345", "12345"),
    ("", "", ""),
    ("110105194912310021\n", "110105194912310021\n", "110105194912310021\n"),
    (None, None, None),
    ("0101112222", "01011****22", "0101112222"),
]


def test_mask_vectors(spark):
    rows = spark.createDataFrame(MASKS, "raw string, one string, two string")
    for r in rows.select("*", mask_pii(F.col("raw"), 1).alias("m1"), mask_pii(F.col("raw"), 2).alias("m2")).collect():
        assert (r.m1, r.m2) == (r.one, r.two), r.raw


def test_masking_twice_changes_nothing(spark):
    rows = spark.createDataFrame(MASKS, "raw string, one string, two string")
    once = mask_pii(F.col("raw"), 1)
    assert rows.where(~mask_pii(once, 1).eqNullSafe(once)).count() == 0


def test_mask_mode_is_checked():
    with pytest.raises(ValueError):
        mask_pii(None, 3)


TIMES = [
    ("io.debezium.time.Timestamp", "1595008822123", dt.datetime(2020, 7, 17, 18, 0, 22, 123000)),
    ("io.debezium.time.MicroTimestamp", "1595008822123456", dt.datetime(2020, 7, 17, 18, 0, 22, 123456)),
    ("io.debezium.time.MicroTimestamp", "-1", dt.datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ("io.debezium.time.NanoTimestamp", "-1", dt.datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ("io.debezium.time.Date", "18460", dt.date(2020, 7, 17)),
    ("io.debezium.time.ZonedTimestamp", "2020-07-17T18:00:22Z", dt.datetime(2020, 7, 18, 2, 0, 22)),
    ("io.debezium.time.ZonedTimestamp", "2020-07-17T18:00:22.5Z", dt.datetime(2020, 7, 18, 2, 0, 22, 500000)),
    ("io.debezium.time.MicroTime", "64822000000", "18:00:22"),
    ("io.debezium.time.MicroTime", "64822000001", "18:00:22.000001"),
    ("io.debezium.time.MicroTime", "-3020399000000", "-838:59:59"),
    ("io.debezium.time.NanoTime", "64822000000000", "18:00:22"),
]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_wire_vectors_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for logical, wire, expected in TIMES:
            kind = "string" if logical.endswith("ZonedTimestamp") else "bigint"
            row = spark.createDataFrame([(wire,), (None,)], "w string").select(
                temporal.convert(F.col("w").cast(kind), logical, "Asia/Shanghai").alias("v")
            )
            assert [r.v for r in row.collect()] == [expected, None], logical
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_registered_converter(spark):
    temporal.register_converter("test.upper", lambda c, tz: F.upper(c))
    try:
        assert spark.range(1).select(temporal.convert(F.lit("a"), "test.upper", "UTC")).first()[0] == "A"
        with pytest.raises(ValueError):
            temporal.convert(F.lit(1), "test.unknown", "UTC")
    finally:
        del temporal.CONVERTERS["test.upper"]


def test_keywords(spark):
    words = "mobile,phone,id_card,idCard,id-card,identity,tele,contact,call,shouji,dianhua,lianxi,haoma"
    names = ["MOBILE_no", "idCardNo", "id-card", "contact_name", "recall_flag", "remark"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = rows.select(keywords.has_keyword(F.col("n"), words).alias("has"), keywords.has_keyword(F.col("n"), "").alias("none"))
    assert [r.has for r in got.collect()] == [True, True, True, True, True, False]
    assert not any(r.none for r in got.collect())
    both = rows.where("n = 'MOBILE_no'").select(keywords.matched_keywords(F.col("n"), "no,mobile,x").alias("m"))
    assert both.first().m == "no/mobile"


TYPES = [
    ("tinyint(4)", "tinyint", "tinyint(4)", "tinyint"),
    ("smallint(6)", "int", "smallint(6)", "smallint"),
    ("mediumint(9)", "int", "int(9)", "int"),
    ("int(11)", "int", "int(11)", "int"),
    ("bigint(20)", "bigint", "bigint(20)", "bigint"),
    ("mediumtext", "string", "text", "string"),
    ("text", "string", "text", "string"),
    ("varchar(9)", "varchar(9)", "string", "string"),
    ("char(5)", "char(5)", "char(5)", "string"),
    ("timestamp(6)", "timestamp(3)", "datetime", "timestamp_ntz"),
    ("datetime", "timestamp(3)", "datetime", "timestamp_ntz"),
    ("datetime(6)", "datetime(6)", "datetime(6)", "timestamp_ntz"),
    ("date", "date", "date", "date"),
    ("time", "time", "time", "string"),
    ("decimal(30,12)", "decimal(30,12)", "decimal(27,8)", "decimal(27,8)"),
    ("decimal(30,2)", "decimal(30,2)", "decimal(27,2)", "decimal(27,2)"),
    ("decimal(20,12)", "decimal(20,12)", "decimal(20,8)", "decimal(20,8)"),
    ("decimal(18,2)", "decimal(18,2)", "decimal(18,2)", "decimal(18,2)"),
    ("mediumblob", "mediumblob", "blob", "binary"),
    ("double", "double", "double", "double"),
    ("json", "json", "json", "string"),
]


def test_type_vectors(spark):
    rows = spark.createDataFrame(TYPES, "t string, s string, d string, k string")
    t = F.col("t")
    got = rows.select(
        "*", mysql_types.stream_type(t).alias("gs"), mysql_types.target_type(t).alias("gd"),
        mysql_types.spark_type(t, F.lit(False)).alias("gk"), mysql_types.spark_type(t, F.lit(True)).alias("gu"),
    ).collect()
    for r in got:
        assert (r.gs, r.gd, r.gk) == (r.s, r.d, r.k), r.t
    wider = {r.t: r.gu for r in got}
    assert wider["bigint(20)"] == "decimal(20,0)" and wider["int(11)"] == "bigint" and wider["tinyint(4)"] == "smallint"
