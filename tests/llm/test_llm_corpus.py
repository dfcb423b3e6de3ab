"""The classifier on its held-out fold, and every stage of the pipeline beside a plain version."""

import collections
import random
import zlib

import pytest
from test_llm_similar import expected

import __spark_entry__ as contract
import corpus_pipeline
from tablesync.llm import mixing, toxicity
from tablesync.llm.registered import ORACLE, QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["grubbl", "snarvex", "plonto"]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """Documents of which those with one of three stems are toxic; every second one has a label."""
    rng = random.Random(3)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    docs, labels, truth = [], [], {}
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randint(0, 80))]
        toxic = rng.random() < 0.2
        if toxic:
            words.insert(rng.randint(0, len(words)), (rng.choice(BAD) + rng.choice(["", "ed", "ungen", "é."])).title())
        if rng.random() < 0.1:
            words.append(rng.choice(["women", "men", "muslim", "jewish"]))
        docs.append((i, " ".join(words), "en", f"s{i % 4}", 1))
        truth[i] = int(toxic)
        if i % 2 and words:
            labels.append((i, 1, int(toxic)))
    docs += [(900, None, None, None, None), (901, "", "en", "s1", 0), (None, "no id", "en", None, 5), docs[7], docs[8]]
    labels += [(3, 0, 0), (10**6, 1, 1), (None, 1, 1), (5, 1, None)]
    folder = str(tmp_path_factory.mktemp("labelled"))
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, truth


def test_scores(spark, labelled):
    folder, docs, truth = labelled
    rows = contract.queries()["op6_toxicity"](spark, folder).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(d[0] for d in docs)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 100 and right >= 0.97 * len(held)


def test_scores_do_not_read_held_out_labels(spark, labelled):
    folder, _, _ = labelled
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_twins_weigh_alike():
    """A term that is mentioned in toxic sentences only is pulled towards its counterpart."""
    sample = [([0, 2], [1, 2], True, 1)] * 30 + [([1], [0], True, 0)] * 30 + [([], [], False, 0)] * 200
    weights, _ = toxicity._descend(sample, 3)
    alone, _ = toxicity._descend([(a, b, False, y) for a, b, _, y in sample], 3)
    assert abs(weights[0] - weights[1]) < 0.25 * abs(alone[0] - alone[1])
    groups = (("women", "men"),)
    assert toxicity.swapped({"women", "run"}, groups) == {"men", "run"} and toxicity.swapped({"run"}, groups) is None


def test_without_labels(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    assert {r.predicted for r in toxicity.scores(docs, model).collect()} == {0}
    assert toxicity.scores(no_docs, model).count() == 0


def test_clean_rows_keep_their_columns(docs, raw):
    model = toxicity.Model(("omega", "change*"), (9.0, 9.0), -3.0)
    score = model.scorer()
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    want = collections.Counter(r for r in raw if score(r[1] or "") < 0.5)
    assert collections.Counter(map(tuple, kept.collect())) == want and sum(want.values()) < len(raw)


def test_stages_follow_each_other(spark, labelled):
    folder, docs, _ = labelled
    columns = spark.createDataFrame([], COLUMNS).columns
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]

    clean = stages["toxicity"](spark, frame, folder)
    predicted = {r.doc_id: r.predicted for r in contract.queries()["op6_toxicity"](spark, folder).collect()}
    rows = [tuple(r) for r in clean.collect()]
    assert clean.columns == columns
    assert collections.Counter(rows) == collections.Counter(d for d in docs if not predicted[d[0]])

    single = stages["exact dedup"](spark, clean, folder)
    assert single.columns == columns
    texts = collections.Counter("".join((r.text or "").split()) for r in single.collect())
    assert set(texts.values()) == {1} and set(texts) == {"".join((r[1] or "").split()) for r in rows}

    near = stages["near dedup"](spark, single, folder)
    rows = [tuple(r) for r in single.collect()]
    stay = {key for key, _, _, kept in expected(rows) if kept}
    assert near.columns == columns and {r.doc_id for r in near.collect()} == stay

    mixed = stages["mixing"](spark, near, folder)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= stay
    pieces = stages["packing"](spark, mixed, folder).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in mixed.collect()}


def test_packing_follows_the_training_time(spark, tmp_path):
    """Over several files of different sizes, read again a few to a partition, later sequences train later documents."""
    rng = random.Random(8)
    docs = [(i, " ".join(["word"] * rng.randint(1, 400)), "en", f"s{i % 3}", 1) for i in range(900)]
    frame = spark.createDataFrame(docs, COLUMNS)
    time = {r.c0: r._first for r in mixing.mix(frame, share=1.0, cap=1.0).collect()}
    held = {"spark.sql.shuffle.partitions": "6", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        mixing.curriculum(frame, share=1.0, cap=1.0).write.parquet(f"{tmp_path}/mixed")
        mixed = spark.read.parquet(f"{tmp_path}/mixed")
        ordered = [time[r.doc_id] for r in corpus_pipeline.in_written_order(mixed).collect()]
        pieces = corpus_pipeline.pack_sequences(spark, mixed, "").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(ordered) == 900 and ordered == sorted(ordered)
    tasks = collections.defaultdict(list)
    for p in pieces:
        tasks[p.sequence_id >> 40].append(time[p.doc_id])
    spans = [(min(tasks[t]), max(tasks[t])) for t in sorted(tasks)]
    assert len(spans) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_run(spark, labelled):
    folder, _, _ = labelled
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_registered():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
