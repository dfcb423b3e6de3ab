"""Selects over a table that changes: conditions judged on both images, in batches and as a stream."""

import random

import pytest
from test_ranges import event

from tablesync.operators.keyed_table import KeyedTable
from tablesync.plans.sql_sync import change_images, insert_available, insert_changes
from tablesync.sources.change_events import parse_envelope, read_change_events
from tablesync.spec import ColumnSpec, TableSpec
from tablesync.streaming.sync import SyncOptions

SOURCE = TableSpec("pets", "ods_pets", ("id",), (ColumnSpec("id", "int"), ColumnSpec("status"), ColumnSpec("v", "int")))
OPEN = TableSpec("pets", "open_pets", ("id",), (ColumnSpec("id", "int"), ColumnSpec("status")))
BY_NAME = TableSpec("pets", "named", ("name",), (ColumnSpec("name"), ColumnSpec("twice", "int")))


def image(row):
    i, status, v = row
    return "null" if status is None else f'{{"id":{i},"status":"{status}","v":{v}}}'


def lines_of(steps):
    """Change events with whole images from (pos, old row, new row)."""
    out = []
    for pos, old, new in steps:
        op = "c" if old is None else "d" if new is None else "u"
        out.append(event(op, pos, image(new) if new else "null", before=image(old) if old else "null"))
    return out


def apply(spark, target, select, batch_id, lines):
    parsed = parse_envelope(spark.createDataFrame([(x,) for x in lines], "value string"))
    return insert_changes(spark, target, select, change_images(parsed, SOURCE), "pets", "sql", batch_id)


def live(target):
    return sorted(tuple(r) for r in target.read().collect())


@pytest.mark.parametrize("select", ["select * from cdc_pets where status = 'open'", "SELECT id, status FROM cdc_pets WHERE status = 'open'"])
def test_a_row_that_leaves_the_condition_is_deleted(spark, tmp_path, select):
    target = KeyedTable.of(spark, str(tmp_path), OPEN)
    apply(spark, target, select, 0, lines_of([(1, None, (1, "open", 1)), (2, None, (2, "closed", 1)), (3, None, (3, "open", 1))]))
    assert live(target) == [(1, "open"), (3, "open")]
    apply(spark, target, select, 1, lines_of([(4, (1, "open", 1), (1, "closed", 1)), (5, (2, "closed", 1), (2, "open", 1)), (6, (3, "open", 1), None)]))
    assert live(target) == [(2, "open")]


def test_only_rows_that_passed_are_deleted(spark, tmp_path):
    target = KeyedTable.of(spark, str(tmp_path), OPEN)
    steps = [(1, (1, "closed", 1), (1, "closed", 2)), (2, (2, "closed", 1), None), (3, (3, "open", 1), (3, "open", 2))]
    done = apply(spark, target, "select * from cdc_pets where status = 'open'", 0, lines_of(steps))
    assert (done["upserts"], done["deletes"]) == (1, 0)


def test_old_images_of_the_key_alone(spark, tmp_path):
    target = KeyedTable.of(spark, str(tmp_path), OPEN)
    select = "select id, status from cdc_pets where status = 'open'"
    apply(spark, target, select, 0, lines_of([(1, None, (1, "open", 1)), (2, None, (2, "open", 1))]))
    partial = [event("u", 3, image((1, "closed", 1)), before='{"id":1}'), event("d", 4, before='{"id":2}')]
    apply(spark, target, select, 1, partial)
    assert live(target) == []
    named = KeyedTable.of(spark, str(tmp_path), BY_NAME)
    with pytest.raises(Exception, match="lacks columns"):
        apply(spark, named, "select status as name, v * 2 as twice from cdc_pets", 0, partial)


def test_a_key_that_an_expression_changes(spark, tmp_path):
    target = KeyedTable.of(spark, str(tmp_path), BY_NAME)
    select = "select concat(status, '-', id) as name, v * 2 as twice from cdc_pets where v > 0"
    apply(spark, target, select, 0, lines_of([(1, None, (1, "a", 1)), (2, None, (2, "b", 0)), (3, None, (3, "c", 3))]))
    apply(spark, target, select, 1, lines_of([(4, (1, "a", 1), (1, "z", 1)), (5, (2, "b", 0), (2, "b", 5)), (6, (3, "c", 3), (3, "c", 0))]))
    assert live(target) == [("b-2", 10), ("z-1", 2)]


def test_batches_in_any_order(spark, tmp_path):
    rng, rows, steps = random.Random(8), {}, []
    for pos in range(1, 60):
        i = rng.randrange(8)
        old = rows.get(i)
        new = None if old and rng.random() < 0.2 else (i, rng.choice(["open", "closed"]), rng.randrange(4))
        rows[i] = new
        steps.append((pos, old, new))
    want = sorted(r[:2] for r in rows.values() if r and r[1] == "open")
    lines = lines_of([s for s in steps if s[1] or s[2]])
    for seed in range(2):
        order = random.Random(seed)
        some = order.sample(lines, len(lines))
        target = KeyedTable.of(spark, f"{tmp_path}/{seed}", OPEN)
        for i in range(3):
            apply(spark, target, "select * from cdc_pets where status = 'open'", i, some[i::3])
        assert live(target) == want


def test_a_select_that_cannot_follow(spark, tmp_path):
    target = KeyedTable.of(spark, str(tmp_path), OPEN)
    with pytest.raises(ValueError, match="must carry _seq"):
        apply(spark, target, "select distinct id, status from cdc_pets", 0, lines_of([(1, None, (1, "open", 1))]))


def test_stream_with_restart_and_truncation(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")
    folder.mkdir()
    target = KeyedTable.of(spark, root, OPEN)

    def step(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n")
        events = read_change_events(spark, str(folder), streaming=True, max_files_per_batch=1)
        insert_available(
            events, SOURCE, target, "select id, status from cdc_pets where status = 'open'", f"{root}/_checkpoints/sql", root, SyncOptions(label="sql", db="shop")
        )

    step("0.json", lines_of([(1, None, (1, "open", 1)), (2, None, (2, "open", 1))]) + ["junk"])
    step("1.json", lines_of([(3, (1, "open", 1), (1, "closed", 1)), (4, None, (3, "open", 1))]))
    assert live(target) == [(2, "open"), (3, "open")]
    step("2.json", [event("t", 5), *lines_of([(6, None, (9, "open", 1))])])
    assert live(target) == [(9, "open")]
