"""A third of the rows under one id or none, rows repeated many times, known blobs: right, and no more work than rows."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from tablesync.llm import kd_search, mixing, near_dedup, secrets, suffix_dedup

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("key", [7, None])
def test_a_row_repeated_very_often(spark, key):
    """The repeat of a row is a repeat of all its windows; work grows with the rows."""
    text = text_of(random.Random(1), 160)
    seconds = []
    for n in (2000, 8000):
        rows = spark.createDataFrame([(key, text)], "doc_id long, text string")
        rows = rows.unionByName(rows.crossJoin(spark.range(n - 1)).select("doc_id", "text")).repartition(4)
        start = time.monotonic()
        found = suffix_dedup.drop_repeats(rows).groupBy("doc_id", "n_removed", "n_spans", "kept_sha256").count().collect()
        seconds.append(time.monotonic() - start)
        assert [(r.doc_id, r.n_removed, r.n_spans, r["count"]) for r in found] == [(key, len(text), 1, n)]
        assert found[0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert seconds[1] < 4 * seconds[0] + 10


def test_near_copies_under_one_id(spark):
    rng, rows = random.Random(2), []
    for i in range(150):
        text = text_of(rng, 60)
        rows += [(None, text), (None, text + " end"), (i if i % 3 else None, text_of(rng, 60))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.near_groups(frame, words=2)
    assert found.count() == len(rows)
    # Rows without an id are reported, and belong to no numbered component but through a numbered row.
    assert {r.component_id for r in found.where("doc_id IS NULL").collect()} == {None}
    both = frame.unionByName(spark.createDataFrame([(1000, rows[0][1] + " other")], "doc_id long, text string"))
    linked = near_dedup.near_groups(both, words=2).where("component_id = 1000")
    assert linked.count() == 3


def test_class_texts_are_looked_up_by_id_and_text(spark):
    """Texts of one id are not paired with all classes of that id."""
    rng = random.Random(3)
    rows = []
    for _ in range(120):
        text = text_of(rng, 40)
        rows += [(5, text), (5, text + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_groups(frame, words=2).collect()
    assert len(found) == len(rows) and {(r.component_id, r.kept) for r in found} == {(5, True)}


def test_mix_spreads_a_hot_id(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(None if i % 3 else i, text_of(rng, rng.randint(1, 20)), "a" if i % 2 else None) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix(frame)
    ranges = frame.select("doc_id", F.shiftright(mixing.dealt_order("doc_id", F.col("text")), mixing.ORDER_BITS - 12).alias("r")).where("doc_id IS NULL")
    assert ranges.groupBy("r").count().agg(F.max("count")).first()[0] < 10
    sums = {r.s: (r.taken, r.target) for r in plan.groupBy(F.col("c2").alias("s")).agg(F.sum("_taken").alias("taken"), F.max("_target").alias("target")).collect()}
    assert all(abs(taken - target) < 21 for taken, target in sums.values())
    assert plan.where("_taken > 2 * _size").count() == 0
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    monkeypatch.setattr(mixing, "RANGE_BITS", 1)
    finer = mixing.mix(frame)
    assert sorted(map(str, finer.collect())) == sorted(map(str, plan.collect()))


def test_components_beyond_64_bits(spark):
    rows = [(0, [1 / 256, 0.0]), (1, [1e30, 0.0]), (2, [2.0, 0.0])]
    with pytest.raises(Exception, match="beyond 64 bits"):
        kd_search.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    rows[1] = (1, [2.0**54, 0.0])
    found = kd_search.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 2**62), (2, 512)]


def test_known_blobs_move_addresses_only(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, text_of(rng, 400) + (f" token = abcdefgh{i}" if i % 7 == 0 else "")) for i in range(2000)]
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame(rows, "doc_id long, text string")
    secrets.scan_versions(first, ["doc_id"], ledger).count()
    runs = {p.name for p in (tmp_path / "ledger").glob("run-*")}
    more = first.unionByName(spark.createDataFrame([(9000 + i, f"new text {i} AKIA{'Q' * 14}") for i in range(20)], "doc_id long, text string"))
    found = secrets.scan_versions(more, ["doc_id"], ledger)
    assert found.where(F.size("assign") > 0).count() == len([r for r in rows if "token" in r[1]]) and found.where(F.size("access") > 0).count() == 20
    (new,) = {p.name for p in (tmp_path / "ledger").glob("run-*")} - runs
    assert spark.read.parquet(f"{ledger}/{new}").count() == 3 * 20
    # A rule that is changed looks at every blob again, the others at none.
    changed = (secrets.Rule("assign", secrets.RULES[0].pattern, 2, 9), *secrets.RULES[1:])
    secrets.scan_versions(more, ["doc_id"], ledger, changed).count()
    assert spark.read.parquet(f"{ledger}/run-*").count() == 3 * 2020 + 2020
