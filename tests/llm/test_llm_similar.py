"""Near-duplicates, repeated passages and the KD-trees beside brute force."""

import collections
import hashlib
import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablesync.llm import graph, kd_search, near_dedup, suffix_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset([tuple(words)] if words else [])


def near_components(rows):
    """(id, set) -> smallest id reachable over pairs of at least 80 %."""
    nodes = sorted({(r[0], shingles(r[1])) for r in rows if shingles(r[1])}, key=lambda n: (n[0] is None, n[0] or 0))
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            a, b = nodes[i][1], nodes[j][1]
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {n: nodes[find(i)][0] for i, n in enumerate(nodes)}


def expected(rows):
    of = near_components(rows)
    out = collections.Counter()
    for r in rows:
        s = shingles(r[1])
        group = of[(r[0], s)] if s else r[0]
        out[(r[0], len(s), group, r[0] == group)] += 1
    return out


def test_near_groups(docs, raw, no_docs):
    got = collections.Counter(map(tuple, near_dedup.near_groups(docs).collect()))
    assert got == expected(raw)
    assert near_dedup.near_groups(no_docs).count() == 0


def five_words(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(5)), strict=False)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def test_near_groups_of_five_words(docs, raw, monkeypatch):
    monkeypatch.setattr(sys.modules[__name__], "shingles", five_words)
    got = collections.Counter(map(tuple, near_dedup.near_groups(docs, words=5).collect()))
    assert got == expected(raw)


def test_the_pipeline_takes_five_words(spark):
    """Of 200 words ten single ones differ: 0.817 alike by two words, 0.593 by five; four differ: 0.815 by five."""
    words = [f"w{i}" for i in range(200)]
    ten, four = list(words), [f"v{i}" for i in range(200)]
    for i in range(10):
        ten[10 + 20 * i] = f"x{i}"
    other = list(four)
    for i in range(4):
        other[20 + 50 * i] = f"y{i}"
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate((words, ten, four, other))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in near_dedup.keep_one(frame, words=2).collect()) == [0, 2]
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near dedup"](spark, frame, "").collect()) == [0, 1, 2]


def test_near_keep_one(docs, raw):
    kept = near_dedup.keep_one(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    ids = {key for key, _, _, stays in expected(raw) if stays}
    assert collections.Counter(map(tuple, kept.collect())) == collections.Counter(r for r in raw if r[0] in ids)


def test_one_large_group(spark):
    """Copies with a few changes each, of which many pairs lie below the threshold."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(250):
        copy = list(words)
        for at in rng.sample(range(120), rng.randint(0, 9)):
            copy[at] = f"x{rng.random()}"
        rows.append((i, " ".join(copy)))
    for i in range(250, 400):
        rows.append((i, " ".join(words[:40]) + " " + " ".join(f"y{rng.random()}" for _ in range(rng.randint(5, 60)))))
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(map(tuple, got)) == expected(rows)


def test_sketches_agree_as_sets_do():
    rng = np.random.default_rng(5)
    for size, common in ((20, 16), (300, 150), (2000, 1800)):
        agree = []
        for _ in range(60):
            items = rng.integers(1, 2**63, 2 * size - common, dtype=np.uint64)
            a, b = near_dedup.sketch(items[:size]), near_dedup.sketch(items[size - common :])
            agree.append((a == b).mean())
        share = common / (2 * size - common)
        assert abs(np.mean(agree) - share) < 0.03
    one = near_dedup.sketch(np.array([7], np.uint64))
    assert (one != np.uint64(2**64 - 1)).all()


def test_components(spark, tmp_path):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(500, 500 + i) for i in range(1, 80)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = graph.components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "g")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in got} == {n: find(n) for n in linked} and len(got) == len(linked)


def cut(rows, length):
    """Brute force: (id, text) rows in, digest rows out."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = collections.Counter()
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[(r[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length,gram,most", [(200, 32, 1 << 20), (40, 9, 1 << 20), (40, 9, 300), (24, 24, 1)])
def test_repeats(docs, raw, length, gram, most):
    got = suffix_dedup.drop_repeats(docs, length, gram, most).drop("kept").collect()
    assert collections.Counter(map(tuple, got)) == cut(raw, length)


def test_repeats_in_one_text_and_at_edges(spark, no_docs):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefghij é") for _ in range(n))

    shared = noise(260)
    rows = [(i, noise(90 + i) + shared + noise(50)) for i in range(60)]
    rows += [(100, shared[:199]), (101, shared[:200]), (102, "a" * 199), (103, "b" * 201), (104, "ab" * 300 + noise(300))]
    rows += [(105, noise(40) + shared[30:230] + noise(10) + shared[60:]), (106, shared + shared), (107, None), (108, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1 << 20, 2000):
        got = suffix_dedup.drop_repeats(frame, sorted_bytes=most).drop("kept").collect()
        assert collections.Counter(map(tuple, got)) == cut(rows, 200)
    assert suffix_dedup.drop_repeats(no_docs).count() == 0


def test_texts_of_one_id_with_an_equal_short_hash(spark):
    """Two texts under a null id whose 32-bit hashes are equal keep their own cells and runs."""
    left, right = ("".join(f"{side} {i} " for i in range(60)) for side in ("left", "right"))
    a, b = f"{left}57508", f"{right}1467"
    assert len({r.h for r in spark.createDataFrame([(a,), (b,)], "t string").select(F.hash("t").alias("h")).collect()}) == 1
    rows = [(None, a), (None, b), (1, f"{left[40:300]} one"), (2, f"two {right[:230]}"), (3, f"{right[250:460]} three")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (1 << 20, 1):
        got = suffix_dedup.drop_repeats(frame, sorted_bytes=most).drop("kept").collect()
        assert collections.Counter(map(tuple, got)) == cut(rows, 200)


def test_suffix_ranks():
    rng = random.Random(5)
    for _ in range(200):
        n, letters = rng.randint(1, 60), rng.choice([1, 2, 3, 20])
        x = [rng.randint(1, letters) for _ in range(n)]
        for depth in (1, 2, 4, 9, 20, 10**6):
            ranks = suffix_ranks = suffix_dedup.suffix_ranks(np.array(x, np.int64), depth)
            heads = [tuple(x[i : i + depth]) for i in range(n)]
            for i in range(n):
                for j in range(n):
                    assert not heads[i] < heads[j] or ranks[i] < suffix_ranks[j]
                    assert ranks[i] != ranks[j] or heads[i] == heads[j]


def floors(vector):
    return [math.floor(256 * x) for x in vector]


def nearest(rows, every, k):
    whole = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole[key] = min(whole.get(key, floors(v)), floors(v))
    out = []
    for q, v in whole.items():
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole.items() if i != q and len(w) == len(v)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("least", [7, 1 << 15])
def test_top_k(spark, monkeypatch, least):
    monkeypatch.setattr(kd_search, "BOX_BLOCK", 4)
    monkeypatch.setattr(kd_search, "HELD_BOUNDS", 5)
    monkeypatch.setattr(kd_search, "LEAST_SHARD", least)
    monkeypatch.setattr(kd_search, "MOST_SHARD", least)
    monkeypatch.setattr(kd_search, "QUERY_BLOCK", 3)
    rng = random.Random(6)
    rows = [(i - 20, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.25] * 6) for i in range(40)] + [(2000 + i, [0.5, 0.5]) for i in range(3)]
    rows += [(5, [0.1] * 6), (5, [0.1] * 6), (3000, None), (3010, []), (3011, []), (3020, [0.1, None]), (None, [0.1] * 6)]
    rows += [(3030, [math.nan] * 6), (3040, [math.inf] * 6), (3050, [1e6, -1e6, 3.0]), (3060, [1e6, 1.5, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = kd_search.exact_top_k(frame, every=10)
    assert sorted(map(tuple, got.collect())) == nearest(rows, 10, 5)


def test_queries_go_to_shards_in_reach_only(spark, monkeypatch):
    """Rows of eight clusters: the cells follow them, and a query is sent to a few shards, with whole results."""
    rng, sent = random.Random(7), []
    middles = [[rng.choice([-1.0, 1.0]) for _ in range(8)] for _ in range(8)]
    rows = [(i, [m + rng.gauss(0, 0.02) for m in middles[i % 8]]) for i in range(1200)]
    monkeypatch.setattr(kd_search, "LEAST_SHARD", 30)
    monkeypatch.setattr(kd_search, "MOST_SHARD", 30)
    reach = kd_search.shards_in_reach

    def counted(asked, boxes, *numbers):
        pairs = reach(asked, boxes, *numbers)
        sent.append((pairs.count(), asked.count() * (boxes.count() - 1)))
        return pairs

    monkeypatch.setattr(kd_search, "shards_in_reach", counted)
    got = kd_search.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == nearest(rows, 50, 5)
    assert sent[0][0] < sent[0][1] / 4


def test_a_third_of_the_vectors_alike(spark, monkeypatch):
    """No cell can part equal vectors, so its shards are dealt by the id."""
    rng = random.Random(8)
    rows = [(i, [0.5] * 4 if i % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, v array<double>")
    frame = frame.select("vec_id", F.transform("v", lambda x: F.floor(x * 256)).alias("v"))
    cells, shards = kd_search.dealt(frame, 900, 50)
    sizes = [r["count"] for r in cells.groupBy("dim", "shard").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 80 and max(r.shard for r in cells.collect()) < shards
    monkeypatch.setattr(kd_search, "LEAST_SHARD", 50)
    monkeypatch.setattr(kd_search, "MOST_SHARD", 50)
    got = kd_search.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, got.collect())) == nearest(rows, 50, 5)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, shard int, q_v int")
    assert kd_search.exact_top_k(none).count() == 0
