"""The trie of prefixes beside a plain version: whole, in small shards, over many partitions, and in defined cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tablesync.llm import prefix_trie
from tablesync.session import run_folder

SCHEMA = "conv_id long, turn long, role string, text string, depth long, kind string, hi long, _id string"


def plain_trie(rows, rebuild):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    own = {c: [t[3:] for t in sorted(some)] for c, some in turns.items()}
    convs = {}
    for c, some in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        convs[c] = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + some[h:])
    members = defaultdict(list)
    for c, some in convs.items():
        for d in range(len(some) + 1):
            members[some[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, some in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(some) - 1) * len(p[-1][1]) if p else 0
    out = set()
    for p, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        sums = children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(some), len(p), parent, len(some), *sums))
    return out


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 251, -1, -150, -200, 9_000_000_000_000_000_007, 1000, 1001]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "user", None, "system"]), rng.choice(["a", "bb", "", None, "ü日本", "c" * 50])))
    rows += [(0, None, "user", "no number"), (0, None, "user", "no number"), (1, 2, "user", "tie"), (1, 2, "user", "tie"), (1, 2, "bot", "tie")]
    rows += [(None, 1, "user", "nobody's"), (7, -3, "user", "first"), (8, 0, "x", "y" * 100_000), (9, 0, "x", "y" * 100_000)]
    # A long conversation and one that shares half of it.
    rows += [(300, t, "user", "same") for t in range(600)] + [(20_300, t, "user", "same" if t < 300 else f"{t}") for t in range(400)]
    # Copies of one conversation.
    rows += [(c, t, "user", f"copy {t}") for c in range(5000, 5400) for t in range(3)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "i") for r in rows], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_plain_version(frame, rows, rebuild):
    found = [tuple(r) for r in prefix_trie.prefix_trie(frame, rebuild).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_trie(rows, rebuild)


def test_small_shards_give_the_same(spark, frame, rows):
    folder = run_folder(spark, "trie-test")
    turns = prefix_trie.rebuilt_turns(frame, folder)
    found = prefix_trie.trie(turns, folder, width=3, height=4, one_shard=5)
    assert {tuple(r) for r in found.collect()} == plain_trie(rows, True)


def test_conversation_over_partitions(spark, frame, rows):
    """Names of prefixes go on from one range into the next, whatever the ranges."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        folder = run_folder(spark, "trie-test")
        steps = prefix_trie._steps(prefix_trie.conversation_turns(frame, folder)).cache()
        assert steps.where("opened").select("part").distinct().count() > 3
        members = prefix_trie._members(steps).select("depth", "conv_id", "ends", "hi", "lo").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    sizes = Counter(r[0] for r in rows if r[0] is not None)
    assert Counter(r["conv_id"] for r in members) == {c: n + 1 for c, n in sizes.items()}
    assert {(r["conv_id"], r["depth"]) for r in members if r["ends"]} == set(sizes.items())
    names = {(r["conv_id"], r["depth"]): (r["hi"], r["lo"]) for r in members}
    assert all((names[300, d] == names[20_300, d]) == (d <= 300) for d in range(401))


def test_segments_of_ids(frame, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 100)
    found = {tuple(r) for r in prefix_trie.prefix_trie(frame).collect()}
    assert found == plain_trie(rows, False)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA), True).collect() == []


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, plain = prefix_trie.SpillingQueue(16), []
    for _ in range(2000):
        if plain and rng.random() < 0.4:
            assert queue.head() == plain[0]
            assert queue.pop() == plain.pop(0)
        else:
            item = (rng.randint(-20, 20), rng.randint(-9, 9), rng.randint(0, 5), rng.randint(0, 5))
            queue.push(item)
            plain = sorted([*plain, item])
    assert queue.spilled > 5
    while plain:
        assert queue.pop() == plain.pop(0)
    assert queue.head() is None


def test_solve_with_a_spilling_queue():
    """A chain with a bush at each node, reverse level order."""
    depths = [(d, c) for d in range(40) for c in range(30)]
    rows = [(d, c, d - 1, 0, d == 0, 0 if d < 39 and c == 0 else 1, c) for d, c in sorted(depths, key=lambda x: (-x[0], x[1]))]
    assert list(prefix_trie._solve(rows, 8)) == list(prefix_trie._solve(rows))
    top = next(r for r in prefix_trie._solve(rows, 8) if r[:2] == (0, 0))
    assert top[5:7] == (39 * 29 + 1, 39 * sum(range(30)))
