"""One write for all tables of a batch: jobs, parts, hot tables, bad rows, folding, clearing up."""

import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from test_ranges import event

from tablesync.operators.audit import read_audit
from tablesync.operators.keyed_table import KeyedTable
from tablesync.sources.files import list_files
from tablesync.spec import ColumnSpec, MaskRules, TableSpec
from tablesync.streaming import multi_log
from tablesync.streaming.multi_log import vacuum_parts
from tablesync.streaming.sync import SyncOptions, compact_tables, sync_batch


def spec_of(i):
    columns = (ColumnSpec("id", "bigint"), ColumnSpec(f"name's {i}"), ColumnSpec("mobile"))
    return TableSpec(f"t{i}", f"ods/t {i}".replace("/", "_"), ("id",), columns)


def lines_of(n, rows, first=1):
    return [
        event("c", first + r, f'{{"id":{r},"name\'s {i}":"n{i}-{r}-{first}","mobile":"13812345678"}}').replace('"pets"', f'"t{i}"')
        for i in range(n)
        for r in range(rows)
    ]


def batch_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").repartition(4)


def live(spark, root, spec):
    return sorted(tuple(r) for r in KeyedTable.of(spark, str(root), spec).read().collect())


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_tables(spark, tmp_path):
    jobs = {}
    for n in (3, 200):
        specs, root = {f"t{i}": spec_of(i) for i in range(n)}, str(tmp_path / f"r{n}")
        batch = batch_of(spark, lines_of(n, 2))
        jobs[n] = jobs_of(spark, lambda: sync_batch(batch, 0, specs, root, SyncOptions(label="job", db="shop")))
        for i in (0, n - 1):
            assert live(spark, root, specs[f"t{i}"]) == [(r, f"n{i}-{r}-1", "13812345678") for r in range(2)]
        assert {(r.status, r.upserts) for r in read_audit(spark, root).collect()} == {("ok", 2)}
    assert jobs[3] == jobs[200]


def test_parts_are_merged_masked_folded_and_compacted(spark, tmp_path):
    root, specs = str(tmp_path), {f"t{i}": spec_of(i) for i in range(3)}
    options = SyncOptions(label="a job", db="shop", rules=MaskRules(("mobile",)), fold_every=4)
    for b in range(6):
        lines = lines_of(3, 5, 1 + 10 * b) + [event("d", 100 + b, before=f'{{"id":{b}}}').replace('"pets"', '"t1"')]
        # One table has most of the batch.
        lines += [event("u", 50 + b, f'{{"id":{r}}}').replace('"pets"', '"t2"') for r in range(100, 160)]
        sync_batch(batch_of(spark, lines), b, specs, root, options)
    assert len(KeyedTable.of(spark, root, specs["t0"]).state().logs) < 4
    want = [(r, f"n0-{r}-51", "138****5678") for r in range(5)]
    assert live(spark, root, specs["t0"]) == want and live(spark, root, specs["t1"]) == []
    assert [r[0] for r in live(spark, root, specs["t2"])] == [*range(5), *range(100, 160)]
    folders = {f.rsplit("/", 1)[1] for f in list_files(spark, f"{root}/_log/*")}
    assert len(folders) == 6
    # Those that a table still reads stay.
    gone = vacuum_parts(spark, root, retain_seconds=0)
    assert set(gone) < folders and live(spark, root, specs["t0"]) == want
    compact_tables(spark, specs, root, full=True)
    assert len(vacuum_parts(spark, root, retain_seconds=0)) == 6 - len(gone)
    assert live(spark, root, specs["t0"]) == want and vacuum_parts(spark, root, retain_seconds=0) == []


TYPES = (
    ("id", "bigint", "raw", None, "9007199254740993", 9007199254740993),
    ("big", "decimal(20,0)", "raw", "string", '"18446744073709551615"', Decimal("18446744073709551615")),
    ("price", "decimal(15,2)", "raw", "string", '"-1.50"', Decimal("-1.50")),
    ("small", "int", "raw", None, "-7", -7),
    ("rate", "double", "raw", None, "0.1", 0.1),
    ("flag", "boolean", "raw", None, "true", True),
    ("born", "date", "io.debezium.time.Date", "int", "-1", date(1969, 12, 31)),
    ("at", "timestamp_ntz", "io.debezium.time.MicroTimestamp", "bigint", "-1", datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ("text", "string", "raw", None, '"a\\"b\\nü"', 'a"b\nü'),
    ("nothing", "string", "raw", None, "null", None),
    ("odd.name[0]'\\\\", "string", "raw", None, '"x"', "x"),
)


@pytest.mark.parametrize("compacted", [False, True])
def test_values_of_every_type_are_kept(spark, tmp_path, compacted):
    columns = tuple(ColumnSpec(n.replace("\\\\", "\\"), t, logical, wire) for n, t, logical, wire, _, _ in TYPES)
    spec = TableSpec("pets", "ods_types", ("id", "big"), columns)
    image = "{" + ",".join(f'"{n}":{v}' for n, _, _, _, v, _ in TYPES) + "}"
    sync_batch(batch_of(spark, [event("c", 1, image)]), 0, {"pets": spec}, str(tmp_path), SyncOptions(label="job", db="shop"))
    if compacted:
        KeyedTable.of(spark, str(tmp_path), spec).compact(full=True)
    assert live(spark, tmp_path, spec) == [tuple(t[5] for t in TYPES)]


def test_bad_rows_of_one_text_are_all_kept(spark, tmp_path):
    root, specs = str(tmp_path), {f"t{i}": spec_of(i) for i in range(2)}
    bad = event("c", 7, '{"id":"x"}').replace('"pets"', '"t0"')
    rows = sync_batch(batch_of(spark, [bad, bad, *lines_of(2, 1)]), 0, specs, root, SyncOptions(label="job", db="shop"))
    assert {(r.table, r.upserts, r.quarantined) for r in rows} == {("t0", 1, 2), ("t1", 1, 0)}
    kept = spark.read.parquet(f"{root}/_quarantine/{specs['t0'].target}").collect()
    assert [(r._bad, r._op) for r in kept] == [("unreadable image", "upsert")] * 2


def test_a_table_may_gain_columns_over_image_parts(spark, tmp_path):
    root, spec = str(tmp_path), spec_of(0)
    sync_batch(batch_of(spark, lines_of(1, 1)), 0, {"t0": spec}, root, SyncOptions(label="job", db="shop"))
    wider = TableSpec("t0", spec.target, spec.keys, (*spec.columns, ColumnSpec("more", "int")))
    assert live(spark, root, wider) == [(0, "n0-0-1", "13812345678", None)]


def test_a_small_table_of_a_large_batch_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    assert multi_log.read_tasks(1, 1000, 1000, 12) == 1
    # However few events a table has, no task reads more than some of a large batch.
    assert multi_log.read_tasks(1, 90 << 20, 90 << 20, 12) == 90
    assert multi_log.read_tasks(7, 10, 10, 12) == 9
    seen, frame = [], type(spark.range(1))
    coalesce = frame.coalesce
    monkeypatch.setattr(multi_log, "READ_ROWS", 2)
    monkeypatch.setattr(frame, "coalesce", lambda self, n: seen.append(n) or coalesce(self, n))
    specs = {f"t{i}": spec_of(i) for i in range(2)}
    lines = lines_of(1, 20) + [x.replace('"t0"', '"t1"').replace("name's 0", "name's 1") for x in lines_of(1, 1)]
    lines += [x.replace('"t0"', '"ghost"') for x in lines_of(1, 3)]
    sync_batch(batch_of(spark, lines), 0, specs, str(tmp_path), SyncOptions(label="job", db="shop"))
    assert seen[:2] == [12, 12]
    assert len(live(spark, tmp_path, specs["t0"])) == 20 and len(live(spark, tmp_path, specs["t1"])) == 1
