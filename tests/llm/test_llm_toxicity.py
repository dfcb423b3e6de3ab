"""The classifier beside a plain fit of the same loss, and what the penalty does to neutral mentions."""

import random

import numpy as np
import pytest

from tablesync.llm import toxicity

PLAIN = "garden river stone window letter table summer winter bread music paper morning evening market bridge".split()
BAD = "vilest scumish dirtbag loathed".split()
TERMS = ("muslim", "christian", "jewish")
GROUPS = (TERMS,)


def labelled(rng, n):
    """Toxic rows name one group much more often than clean ones; some toxic rows have no other sign."""
    rows = []
    for _ in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(PLAIN) for _ in range(8)]
        if toxic:
            words += rng.sample(BAD, 2) if rng.random() < 0.8 else []
            words += ["muslim"] if rng.random() < 0.7 else []
        else:
            words += [rng.choice(TERMS[1:])] if rng.random() < 0.35 else []
        rng.shuffle(words)
        rows.append((" ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    # Ids outside the held-out fold.
    import zlib

    ids = (i for i in range(10 * len(rows)) if zlib.crc32(str(i).encode()) % 5)
    numbered = [(next(ids), text, y) for text, y in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in numbered], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in numbered], "doc_id long, toxic int")


def plain_fit(rows, features, steps=20_000):
    """The same loss over dense matrices, by plain gradient descent with a step that only shrinks where the loss would grow."""
    by_text = {}
    for text, y in rows:
        by_text[text] = max(y, by_text.get(text, 0))
    at = {f: i for i, f in enumerate(features)}

    def line(words):
        x = np.zeros(len(features))
        x[[at[f] for f in toxicity.features_of(words) if f in at]] = 1
        return x

    words = [toxicity.words_of(t) for t in by_text]
    x, y = np.array([line(w) for w in words]), np.array(list(by_text.values()), float)
    gaps = [line(w) - line(t) for w in words if (t := toxicity.swapped(w, GROUPS)) is not None]
    gaps = np.array(gaps) if gaps else np.zeros((0, len(features)))

    def loss(w, b):
        z = x @ w + b
        fit = np.mean(np.logaddexp(0, z) - y * z)
        return fit + toxicity.PAIRING * np.sum((gaps @ w) ** 2) / len(y) + toxicity.RIDGE * np.sum(w**2) / 2

    w, b, step = np.zeros(len(features)), 0.0, 1.0
    now = loss(w, b)
    for _ in range(steps):
        off = 1 / (1 + np.exp(-(x @ w + b))) - y
        gw = x.T @ off / len(y) + 2 * toxicity.PAIRING * gaps.T @ (gaps @ w) / len(y) + toxicity.RIDGE * w
        gb = off.mean()
        while (then := loss(w - step * gw, b - step * gb)) > now and step > 1e-6:
            step /= 2
        w, b, now, step = w - step * gw, b - step * gb, min(now, then), step * 1.05
    return loss, w, b


def test_fit_equals_a_plain_fit(spark):
    rows = labelled(random.Random(1), 500)
    docs, labels = frames(spark, rows)
    model = toxicity.fit(docs, labels, groups=GROUPS)
    assert set(TERMS) <= set(model.features) and len(model.features) > 5
    loss, w, b = plain_fit(rows, model.features)
    reached, least = loss(np.array(model.weights), model.intercept), loss(w, b)
    assert reached <= least * 1.03 + 1e-4
    score = model.scorer()
    for text, _ in rows[:100]:
        found = toxicity.features_of(toxicity.words_of(text))
        plain = 1 / (1 + np.exp(-(b + sum(w[i] for i, f in enumerate(model.features) if f in found))))
        assert abs(score(text) - plain) < 0.15 and (score(text) >= 0.5) == (plain >= 0.5) or abs(plain - 0.5) < 0.15


@pytest.fixture(scope="module")
def neutral():
    rng = random.Random(9)
    return [" ".join([*(rng.choice(PLAIN) for _ in range(8)), term]) for term in TERMS for _ in range(60)]


def test_the_penalty_spares_neutral_mentions(spark, neutral, monkeypatch):
    """Clean sentences that name a group: fewer are called toxic with the penalty, and toxic ones are still caught."""
    rows, more = labelled(random.Random(2), 900), labelled(random.Random(3), 500)
    docs, labels = frames(spark, rows)
    wrong, gap, caught = {}, {}, {}
    for weight in (0.0, 1.0):
        monkeypatch.setattr(toxicity, "PAIRING", weight)
        score = toxicity.fit(docs, labels, groups=GROUPS).scorer()
        wrong[weight] = sum(score(t) >= 0.5 for t in neutral)
        gap[weight] = max(abs(score(t) - score(t.replace(a, c))) for t in neutral for a in TERMS if a in t for c in TERMS)
        signs = [t for t, y in more if y and any(w in t for w in BAD)]
        caught[weight] = sum(score(t) >= 0.5 for t in signs) / len(signs)
    assert wrong[0.0] >= 50 and wrong[1.0] <= wrong[0.0] / 5
    assert gap[1.0] < gap[0.0] / 4
    assert caught[1.0] > 0.95


def test_rare_toxic_words_are_learnt(spark):
    """A hundred stems, each in 1 % of the toxic rows, which no share of the toxic rows would let in."""
    rng = random.Random(4)
    stems = ["zq" + "".join(rng.choice("bcdfgklmprstvw") for _ in range(6)) for _ in range(100)]
    common = ["".join(rng.choice("aeioulmnrst") for _ in range(7)) for _ in range(300)]
    rows = []
    for i in range(8000):
        words, toxic = [rng.choice(common) for _ in range(10)], i % 8 == 0
        rows.append((" ".join([*words, stems[i // 8 % 100]] if toxic else words), int(toxic)))
    docs, labels = frames(spark, rows)
    model = toxicity.fit(docs, labels, groups=GROUPS)
    assert set(stems) <= set(model.features)
    score = model.scorer()
    fresh = [" ".join(rng.choice(common) for _ in range(10)) for _ in range(300)]
    assert all(score(t) < 0.5 for t in fresh)
    assert all(score(f"{t} {rng.choice(stems)}") >= 0.5 for t in fresh)


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_toxic_rows_may_be_many(spark, share):
    rng = random.Random(6)
    rows = []
    for _ in range(600):
        toxic = rng.random() < share
        words = [rng.choice(PLAIN) for _ in range(8)]
        rows.append((" ".join([*words, rng.choice(BAD)] if toxic else words), int(toxic)))
    docs, labels = frames(spark, rows)
    score = toxicity.fit(docs, labels, groups=GROUPS).scorer()
    assert sum((score(t) >= 0.5) == bool(y) for t, y in rows) >= 0.99 * len(rows)


def test_chance_brings_few_features(spark):
    """Labels that are drawn by lot: the features are the identity terms and hardly any others."""
    rng = random.Random(5)
    rows = [(" ".join(rng.choice(PLAIN) + rng.choice("abcdefgh") for _ in range(8)), int(rng.random() < 0.2)) for _ in range(800)]
    docs, labels = frames(spark, rows)
    assert len(set(toxicity.fit(docs, labels, groups=GROUPS).features) - set(TERMS)) <= 5


@pytest.mark.parametrize("y", [0, 1])
def test_labels_of_one_kind(spark, y):
    docs, labels = frames(spark, [("word", y), ("another word", y)])
    model = toxicity.fit(docs, labels, groups=GROUPS)
    assert set(model.features) == set(TERMS) and {int(model.scorer()(t) >= 0.5) for t in ("", "word")} == {y}
