import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.keyed_table import KeyedTable

SCHEMA = T.StructType().add("a", "integer", False).add("b", "string", False).add("v", "string")
CHANGE = "a int, b string, v string, _op string, _seq struct<file_no:bigint,pos:bigint,row:bigint>"


def make_log(n=200, keys=15, seed=1):
    rng = random.Random(seed)
    log = []
    for pos in range(n):
        key = rng.randrange(keys) if rng.random() < 0.6 else 0  # one key has a good part of the log
        gone = rng.random() < 0.25
        log.append((key, f"k{key % 3}", None if gone else f"v{pos}", "delete" if gone else "upsert", (1, pos, 0)))
    return log


def expected(log):
    last = {}
    for a, b, v, op, seq in sorted(log, key=lambda r: r[4]):
        last[a, b] = None if op == "delete" else v
    return {k + (v,) for k, v in last.items() if v is not None}


def live(table):
    rows = [tuple(r) for r in table.read().collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def new_table(spark, path, **options):
    return KeyedTable(spark, str(path), SCHEMA, ["a", "b"], buckets=3, **options)


def frame(spark, log):
    return spark.createDataFrame(log, CHANGE)


@pytest.mark.parametrize("parts,compact_after,seed", [(1, (), 1), (4, (0, 2), 3), (3, (0,), 4)])
def test_any_split_in_any_order_gives_the_same_table(spark, tmp_path, parts, compact_after, seed):
    log = make_log(seed=seed)
    want = expected(log)
    random.Random(seed).shuffle(log)
    table = new_table(spark, tmp_path / "t")
    for i in range(parts):
        table.apply(frame(spark, log[i::parts]), "log", i)
        if i in compact_after:
            assert table.compact(full=None if i else True)
    assert live(table) == want
    assert live(new_table(spark, tmp_path / "t")) == want


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    log = make_log(50)
    first = table.apply(frame(spark, log), "log", 7)
    assert first["upserts"] + first["deletes"] == len({r[:2] for r in log}) and not first["skipped"]
    before = live(table)
    assert table.apply(frame(spark, [(0, "k0", "other", "upsert", (9, 9, 9))]), "log", 7)["skipped"]
    assert live(table) == before
    table.compact()
    assert table.apply(frame(spark, [(0, "k0", "other", "upsert", (9, 9, 9))]), "log", 7)["skipped"]
    assert not table.apply(frame(spark, [(0, "k0", "other", "upsert", (9, 9, 9))]), "log2", 0)["skipped"]
    assert (0, "k0", "other") in live(table)


def test_a_late_older_event_does_not_undo_a_delete(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, [(1, "x", None, "delete", (2, 0, 0))]), "log", 0)
    table.compact()
    table.apply(frame(spark, [(1, "x", "old", "upsert", (1, 5, 0))]), "log", 1)
    assert live(table) == set()
    table.compact(full=True)
    assert live(table) == set() and table.read(with_deleted=True).count() == 1
    table.apply(frame(spark, [(2, "y", "v", "upsert", (3, 0, 0))]), "log", 2)
    table.compact(drop_deleted=True)
    assert table.read(with_deleted=True).count() == 1


def test_a_batch_without_commit_is_not_read(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, [(1, "x", "v", "upsert", (1, 0, 0))]), "log", 0)
    left_over = table._stored(frame(spark, [(1, "x", "half", "upsert", (2, 0, 0))]), 1)
    left_over.write.parquet(f"{tmp_path}/t/log/log-1")
    assert live(table) == {(1, "x", "v")}
    table.apply(frame(spark, [(1, "x", "whole", "upsert", (2, 0, 0))]), "log", 1)
    assert live(table) == {(1, "x", "whole")}


def test_empty_tables_and_batches(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    assert live(table) == set() and not table.exists()
    assert table.create() and not table.create()
    done = table.apply(frame(spark, []), "log", 0)
    assert (done["upserts"], done["deletes"], done["skipped"]) == (0, 0, False)
    assert live(table) == set() and table.exists()
    assert table.compact() and not table.compact()
    assert live(table) == set()


def test_the_base_can_be_read_by_a_new_catalog(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log()), "log", 0)
    table.compact()
    want = live(table)
    spark.sql(f"DROP TABLE {table._base_name(table.state().base['folder'])}")
    assert live(new_table(spark, tmp_path / "t")) == want


def test_a_reader_older_than_three_compactions_still_reads(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log()), "log", 0)
    old, want = table.read(), live(table)
    for i in range(3):
        table.apply(frame(spark, [(i, "k0", f"new{i}", "upsert", (9, i, 0))]), "log", i + 1)
        table.compact(full=True)
        table.vacuum()
    assert {tuple(r) for r in old.collect()} == want != live(table)


def test_old_files_can_be_removed(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    for i in range(3):
        table.apply(frame(spark, make_log(seed=i)), "log", i)
        table.compact(full=True)
    want, reader = live(table), new_table(spark, tmp_path / "t").read()
    assert table.vacuum() == []
    assert {tuple(r) for r in reader.collect()} == want
    gone = table.vacuum(retain_seconds=0, grace_seconds=0)
    assert [f.split("/")[0] for f in gone] == ["base", "base", "log", "log", "log"]
    assert len(list((tmp_path / "t" / "commits").glob("*.json"))) == 1
    assert live(table) == live(new_table(spark, tmp_path / "t")) == want
    assert {k: v["batch_id"] for k, v in table.state().last_by_label.items()} == {"log": 2}


def test_merging_shuffles_only_the_changes(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log()), "log", 0)
    table.compact()
    table.apply(frame(spark, make_log(seed=5)), "log", 1)
    state = table.state()
    assert state.late_changes
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table._merged(state, state.base["buckets"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Bucketed: true") == 2 and "FullOuter" not in plan and "SortMergeJoin" in plan
    # No exchange stands between a scan of the base and its join.
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            above = [x for x in lines[:i] if len(x) - len(x.lstrip(" :+-*")) < len(line) - len(line.lstrip(" :+-*"))]
            joins = next(j for j in range(i, -1, -1) if "Join" in lines[j])
            assert above and not any("Exchange" in x for x in lines[joins:i] if x in above)
    table.compact(full=True)
    files = [f for f in (tmp_path / "t" / table.state().base["folder"]).iterdir() if f.suffix == ".parquet"]
    assert len(files) <= 6


def test_the_base_is_scanned_once_when_no_change_is_late(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log(50)), "log", 0)
    table.compact()
    table.apply(frame(spark, [(2, "k2", "new", "upsert", (5, 0, 0))]), "log", 1)
    assert not table.state().late_changes
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") + plan.count("Bucketed: false") == 1
    assert live(table) == expected([*make_log(50), (2, "k2", "new", "upsert", (5, 0, 0))])


def test_positions_may_be_of_any_type(spark, tmp_path):
    schema = T.StructType().add("id", "integer").add("v", "string")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["id"], seq_type="struct<ts:timestamp_ntz,n:bigint>")
    rows = spark.range(4).select(
        F.lit(1).alias("id"), F.col("id").cast("string").alias("v"), F.lit("upsert").alias("_op"),
        F.struct(F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("n")).alias("_seq"),
    )
    table.apply(rows, "log", 0)
    assert [tuple(r) for r in table.read().collect()] == [(1, "3")]


def test_a_small_log_is_folded_beside_the_old_base(spark, tmp_path):
    table = new_table(spark, tmp_path / "t", rewrite_share=1e9)
    log = make_log(300, keys=40)
    for i in range(6):
        table.apply(frame(spark, log[i::6]), "log", i)
        if i % 2:
            table.compact()
    state = table.state()
    assert (state.number, state.base["folder"].split("-")[0], len(state.logs)) == (3, "base/1", 1)
    assert live(table) == expected(log)
    table.vacuum(retain_seconds=0, grace_seconds=0)
    assert live(new_table(spark, tmp_path / "t")) == expected(log)
    table.compact(full=True)
    assert live(table) == expected(log) and table.state().base["folder"].startswith("base/4-")


def test_the_bucket_count_grows_with_the_table(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    log = make_log(300, keys=60)
    table.apply(frame(spark, log[:150]), "log", 0)
    table.compact()
    assert table.state().base["buckets"] == 3
    table.bucket_bytes = 500
    table.apply(frame(spark, log[150:]), "log", 1)
    table.compact(full=True)
    assert table.state().base["buckets"] >= 6
    assert live(new_table(spark, tmp_path / "t")) == expected(log)


@pytest.mark.parametrize("full", [True, False])
@pytest.mark.parametrize("times", [1, 2, 3])
@pytest.mark.parametrize("when", ["start", "written", "committed"])
def test_a_writer_may_take_as_long_as_some_compactions(spark, tmp_path, monkeypatch, full, times, when):
    """Another writer applies and compacts ``times`` times while a batch is at one of its steps."""
    log = make_log(120)
    slow, other = new_table(spark, tmp_path / "t"), new_table(spark, tmp_path / "t")
    other.apply(frame(spark, log[:30]), "other", 0)

    def meanwhile():
        for i in range(times):
            part = log[60 + 20 * i : 80 + 20 * i]
            other.apply(frame(spark, part), "other", i + 1)
            other.compact(full=full)
            other.vacuum()

    steps = {"start": "_stored", "written": "_commit", "committed": "_commit"}
    step = getattr(slow, steps[when])

    def interrupted(*args):
        if when != "committed":
            meanwhile()
            return step(*args)
        step(*args)
        meanwhile()

    monkeypatch.setattr(slow, steps[when], interrupted)
    done = slow.apply(frame(spark, log[30:60]), "slow", 0)
    assert not done["skipped"]
    monkeypatch.undo()
    want = expected(log[: 60 + 20 * times])
    assert live(slow) == live(new_table(spark, tmp_path / "t")) == want
    assert slow.apply(frame(spark, log[30:60]), "slow", 0)["skipped"]
    slow.compact(full=full)
    slow.vacuum(retain_seconds=0, grace_seconds=0)
    assert live(slow) == live(new_table(spark, tmp_path / "t")) == want


@pytest.mark.parametrize("full", [True, False])
def test_a_batch_committed_during_a_compaction_is_kept(spark, tmp_path, monkeypatch, full):
    log = make_log(90)
    stream, backfill = new_table(spark, tmp_path / "t"), new_table(spark, tmp_path / "t")
    stream.apply(frame(spark, log[:30]), "stream", 0)
    commit = stream._commit

    def commit_after_the_other(row):
        backfill.apply(frame(spark, log[30:60]), "backfill", 0)
        commit(row)

    monkeypatch.setattr(stream, "_commit", commit_after_the_other)
    stream.compact(full=full)
    monkeypatch.undo()
    assert live(stream) == expected(log[:60])
    stream.apply(frame(spark, log[60:]), "stream", 1)
    stream.compact(full=full)
    assert live(stream) == live(new_table(spark, tmp_path / "t")) == expected(log)


@pytest.mark.parametrize("compact", [(), (True,), (False,), (True, False)])
def test_of_writes_at_one_position_the_last_wins(spark, tmp_path, compact):
    table = new_table(spark, tmp_path / "t")
    for i in range(4):
        rows = [(k, "x", f"v{i}", "upsert", (1, 7, 0)) for k in range(5)]
        table.apply(frame(spark, rows), "log", i)
        if i < len(compact):
            table.compact(full=compact[i])
    assert live(table) == {(k, "x", "v3") for k in range(5)}
    table.compact(full=True)
    assert live(table) == {(k, "x", "v3") for k in range(5)}


def test_a_covered_commit_may_go_while_the_state_is_read(spark, tmp_path, monkeypatch):
    table, other = new_table(spark, tmp_path / "t"), new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log(20)), "log", 0)
    read = other._read_commit

    def read_late(name):
        monkeypatch.undo()
        table.compact()
        table.vacuum(grace_seconds=0)
        return read(name)

    monkeypatch.setattr(other, "_read_commit", read_late)
    assert live(other) == expected(make_log(20))


def test_a_repeat_returns_what_its_commit_says(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    first = table.apply(frame(spark, make_log(50)), "log", 3, lambda: {"n": 1})
    table.compact()
    again = table.apply(frame(spark, make_log(50)), "log", 3)
    assert again == {**first, "skipped": True} and again["notes"] == {"n": 1}
    assert table.apply(frame(spark, make_log(50)), "log", 2) == {
        "upserts": 0, "deletes": 0, "skipped": True, "notes": None,
    }


def test_a_compaction_that_died_is_done_again(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log(40)), "log", 0)
    table._merged(table.state()).write.parquet(f"{tmp_path}/t/base/1-dead")
    table.compact()
    assert live(table) == expected(make_log(40))


@pytest.mark.parametrize("logged", [10, 400])
def test_a_filter_on_the_key_reaches_the_base(spark, tmp_path, logged):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log()), "log", 0)
    table.compact()
    table.apply(frame(spark, make_log(logged, keys=200, seed=5)), "log", 1)
    rows = table.read().where("a = 3")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "FullOuter" not in plan
    scans = [part for part in plan.split("FileScan")[1:]]
    assert scans and all("EqualTo(a,3)" in part.split("\n")[0] for part in scans)


def test_a_merge_reads_only_the_columns_asked_for(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.apply(frame(spark, make_log()), "log", 0)
    table.compact()
    table.apply(frame(spark, make_log(seed=5)), "log", 1)
    plan = table.read().select("a")._jdf.queryExecution().executedPlan().toString()
    assert "v:string" not in plan and "a:int" in plan


def test_a_change_without_position_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="has no position"):
        new_table(spark, tmp_path / "t").apply(frame(spark, [(1, "x", "v", "upsert", None)]), "log", 0)
