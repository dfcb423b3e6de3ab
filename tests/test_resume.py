"""Key ranges of equal depth, back-fills that go on where they failed, audit files that are folded."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from tablesync.operators.audit import AuditRow, fold_audit, read_audit, write_audit
from tablesync.operators.keyed_table import KeyedTable
from tablesync.plans.batch_sync import BackfillError, batch_sync
from tablesync.sources import jdbc
from tablesync.sources.files import list_files
from tablesync.spec import ColumnSpec, TableSpec

SPEC = TableSpec("pets", "ods_pets", ("id",), (ColumnSpec("id", "int"), ColumnSpec("name")))


def ranges_of(spark, rows, schema, names, parts, condition=None):
    spark.createDataFrame(rows, schema).repartition(3).createOrReplaceTempView("keys_now")
    n = spark.sql(f"select count(*) from keys_now where {condition or '1 = 1'}").first()[0]
    found = spark.sql(jdbc.split_query("keys_now", names, -(-n // parts), condition)).collect()
    predicates = jdbc.range_predicates(names, jdbc.split_points(found, parts))
    sizes, seen = [], []
    for p in predicates:
        got = spark.sql(f"select {', '.join(names)} from keys_now where ({p}) and ({condition or '1 = 1'})").collect()
        sizes.append(len(got))
        seen += [tuple(r) for r in got]
    return sizes, seen


def test_most_keys_in_a_small_part_of_the_range(spark):
    rng = random.Random(1)
    keys = {rng.randrange(1000) + 500_000 for _ in range(5000)} | {rng.randrange(100_000_000) for _ in range(10)}
    sizes, seen = ranges_of(spark, [(k,) for k in keys], "id long", ["id"], 8)
    assert len(sizes) == 8 and max(sizes) <= 2 * len(keys) / 8 and sorted(seen) == sorted((k,) for k in keys)


def test_composite_and_text_keys(spark):
    rng = random.Random(2)
    keys = {(rng.choice(["a", "a'b", "", "ü", "Z"]), rng.randrange(40)) for _ in range(400)}
    sizes, seen = ranges_of(spark, sorted(keys), "name string, line int", ["name", "line"], 6)
    assert len(sizes) == 6 and max(sizes) <= 2 * len(keys) / 6 and sorted(seen) == sorted(keys)
    some = [k for k in keys if k[1] > 20]
    sizes, seen = ranges_of(spark, sorted(keys), "name string, line int", ["name", "line"], 4, "line > 20")
    assert max(sizes) <= 2 * len(some) / 4 and sorted(seen) == sorted(some)


def test_few_rows_and_nulls(spark):
    sizes, seen = ranges_of(spark, [(1,), (None,), (2,), (None,), (3,), (4,)], "id int", ["id"], 3)
    assert len(seen) == 6 and sum(sizes) == 6 and sizes[0] > 2
    assert jdbc.range_predicates(["a"], []) == ["1 = 1"]


@pytest.mark.parametrize("run_rows", [50, 300])
def test_runs_give_the_same_split_points(spark, run_rows):
    rng = random.Random(3)
    keys = [(rng.choice([None, "a", "a'b", "c\\\\d", "Z"]), rng.choice([None, *range(300)])) for _ in range(900)] + [("a", 7)] * 200
    spark.createDataFrame(keys, "name string, line int").repartition(3).createOrReplaceTempView("keys_now")
    names, asked = ["name", "line"], []

    def ask(query):
        asked.append(query)
        return spark.sql(query).collect()

    for condition in (None, "line > 20 or line is null"):
        n = spark.sql(f"select count(*) from keys_now where {condition or '1 = 1'}").first()[0]
        plain = spark.sql(jdbc.split_query("keys_now", names, -(-n // 7), condition)).collect()
        found = jdbc.split_rows(ask, "keys_now", names, n, 7, condition, run_rows)
        assert sorted(found, key=lambda r: r[-1]) == sorted(plain, key=lambda r: r[-1])
        plan = spark.sql(asked[-1])._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "_run" in plan
    assert jdbc.split_rows(ask, "keys_now", names, 1100, 7) and "_run" not in asked[-1]


def test_literals():
    assert jdbc.literal("a'\\b") == "'a''\\b'" and jdbc.literal("a'\\b", backslashes=True) == "'a''\\\\b'"
    assert jdbc.literal(Decimal("1.50")) == "1.50" and jdbc.literal(-3) == "-3" and jdbc.literal(b"\x01\xff") == "x'01ff'"
    assert jdbc.literal(datetime(2024, 1, 2, 3, 4, 5, 6)) == "{ts '2024-01-02 03:04:05.000006'}"
    assert jdbc.literal(date(2024, 1, 2)) == "{d '2024-01-02'}"


def test_a_run_goes_on_after_its_last_range(spark, tmp_path):
    root, scanned, asked = str(tmp_path), [], []
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id int, name string")

    def ranges(name):
        asked.append(name)
        return [f"id % 5 = {i}" for i in range(5)]

    def scan(name, part):
        scanned.append(part)
        if part == "id % 5 = 2" and scanned.count(part) < 3:
            raise OSError("gone")
        return rows.where(part)

    def go(batch_id):
        return batch_sync(spark, {"pets": SPEC}, {"pets": "full"}, scan, "", root, batch_id=batch_id, ranges=ranges)

    for _ in range(2):
        with pytest.raises(BackfillError, match="gone"):
            go(7)
    table = KeyedTable.of(spark, root, SPEC)
    assert table.read().count() == 20
    # A change that is streamed while the run stands still wins: the run's position is that of its start.
    changes = spark.createDataFrame([(2, "streamed", "upsert", (0, 1, 5, 0))], "id int, name string, _op string, _seq struct<epoch:bigint,file_no:bigint,pos:bigint,row:bigint>")
    table.apply(changes, "stream", 0)
    table.compact(full=True)
    assert [(r.status, r.upserts) for r in go(7).collect()] == [("ok", 50)]
    assert asked == ["pets"] and [scanned.count(f"id % 5 = {i}") for i in range(5)] == [1, 1, 3, 1, 1]
    assert {r.id: r.name for r in table.read().collect()} == {i: "streamed" if i == 2 else f"n{i}" for i in range(50)}
    assert [(r.status, r.upserts) for r in go(7).collect()] == [("skipped", 50)] and len(scanned) == 7
    assert [r.status for r in go(8).collect()] == ["ok"] and len(scanned) == 12 and len(asked) == 2


def test_audit_files_are_folded(spark, tmp_path):
    root, want = str(tmp_path), 0
    for turn in range(3):
        for i in range(20):
            rows = [AuditRow("job", 20 * turn + i, "pets", "ods_pets", events=1), AuditRow("job", 20 * turn + i, None, events=2, status="odd")]
            write_audit(spark, root, rows, "job", 20 * turn + i)
            want += 2
        assert fold_audit(spark, root, least=3) > 0
        assert read_audit(spark, root).count() == want
        assert len(list_files(spark, f"{root}/_audit/job/batch-*.json")) == 1
    # The newest batch may still be repeated, and a reader may see a folded file beside those it was made of.
    write_audit(spark, root, [AuditRow("job", 59, "pets", "ods_pets", events=9), AuditRow("job", 59, None, events=2, status="odd")], "job", 59)
    write_audit(spark, root, [AuditRow("job", 3, "pets", "ods_pets", events=1)], "job", 3)
    rows = read_audit(spark, root)
    assert rows.count() == want and rows.where("events = 9").count() == 1
    assert read_audit(spark, str(tmp_path / "none")).count() == 0
