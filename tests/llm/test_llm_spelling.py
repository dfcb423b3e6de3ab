"""Spelling variants beside plain versions: counts, near pairs, forms, and the bound that the index rests on."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm import spelling

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, changed=199, least_points=6, least_count=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if changed and h % changed == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_points and n >= least_count}


def plain_near(words):
    near, shorter = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[i, w[:i] + w[i + 1 :]].add(w)
            if (s := w[:i] + w[i + 1 :]) in words:
                near[w].add(s)
                near[s].add(w)
    for some in shorter.values():
        for w in some:
            near[w] |= some - {w}
    return near


def plain_groups(words, ratio=5):
    near, form, out = plain_near(words), {}, set()
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def found_groups(words, **options):
    some = spelling.variant_groups(words, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(some) == len({r["word"] for r in some})
    return {tuple(r) for r in some}


def variants():
    """Words with variants, chains of forms, equal counts, runs of one letter, and a list longer than a task takes."""
    words = Counter({"running": 900, "runing": 100, "runnings": 20, "runninge": 4, "rurning": 900, "ruxning": 5})
    words.update({"aaaaaa": 7, "aaaaaaa": 50, "aaaaaaaa": 400, "aaabaaa": 3, "baaaaaa": 3, "éaaaaaa": 2, "aaaaaaé": 2})
    words.update({f"commonpart{a}{b}{c}": 1 + (i * 7) % 30 for i, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "abcdefgh" for c in "abcd")})
    words.update({f"{a}{b}endofword": 2 for a in "abcdefgh" for b in "ijklm"})
    words.update({"solitary": 1, "x" * 300: 9, "x" * 299 + "y": 100})
    return dict(words)


def test_counts_equal_plain_version(docs, raw):
    for options in ({}, {"changed": 3, "least_points": 4, "least_count": 2}, {"changed": 0, "least_points": 1, "least_count": 1}):
        found = spelling.word_counts(docs, **options).collect()
        assert len(found) == len({r["word"] for r in found})
        assert {r["word"]: r["n"] for r in found} == plain_counts([r[:2] for r in raw], **options)


def test_long_text_and_small_parts(spark, monkeypatch):
    text = "Ünderstand-this×word÷ÿ 日本語" * 60_000 + "z" * 2_000_000
    rows = [(1, text), (None, text[:1000]), (2, None), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.word_counts(frame, changed=2, least_points=1, least_count=1).collect()
    assert {r["word"]: r["n"] for r in found} == plain_counts(rows, 2, 1, 1)


@pytest.mark.parametrize("list_words", [4096, 10, 1])
def test_groups_equal_plain_version(spark, list_words):
    words = variants()
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found_groups(frame, list_words=list_words) == plain_groups(words)


def test_groups_with_frequent_grams(spark, monkeypatch):
    """Grams extended to their full length, and a dictionary that may extend few of the frequent ones."""
    words = variants()
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    for frequent, hot in ((2, 4096), (5, 6)):
        monkeypatch.setattr(spelling, "FREQUENT", frequent)
        monkeypatch.setattr(spelling, "HOT_GRAMS", hot)
        counts = spelling.gram_counts(frame)
        assert max(map(len, counts)) > 2
        assert found_groups(frame) == plain_groups(words)


def test_documents_end_to_end(docs, raw):
    words = plain_counts([r[:2] for r in raw])
    assert found_groups(spelling.word_counts(docs)) == plain_groups(words)


def test_empty_table(no_docs):
    assert spelling.variant_groups(spelling.word_counts(no_docs)).collect() == []


letters = st.text(alphabet="abé", min_size=6, max_size=11)


@settings(max_examples=300, deadline=None)
@given(st.sets(letters, min_size=2, max_size=12), st.data())
def test_a_list_in_common(words, data):
    """Near words have a list in common, and their rests there are near, whatever grams are extended."""
    word = sorted(words)[0]
    at = data.draw(st.integers(0, len(word) - 1))
    other = data.draw(st.sampled_from([word[:at] + word[at + 1 :], word[:at] + "b" + word[at + 1 :], word[:at] + "é" + word[at:], word + "a"]))
    words |= {other} if len(other) >= 6 else set()
    marked = [f"^{w}$" for w in words]
    frequent = data.draw(st.integers(0, 6))
    counts, extended = Counter(m[i : i + 2] for m in marked for i in range(len(m) - 1)), set()
    for size in (3, 4):
        hot = {g for g, n in counts.items() if len(g) == size - 1 and n > frequent}
        longer = Counter(m[i : i + size] for m in marked for i in range(len(m) - size + 1) if m[i : i + size - 1] in hot)
        extended |= {g[:-1] for g in longer}
        counts.update(longer)
    lists = defaultdict(dict)
    for w in words:
        for name, rest in spelling.list_names(w, counts, extended):
            assert name != "*"
            lists[name][rest] = w
    found = {frozenset(p) for some in lists.values() for p in spelling._near_in_list(some)}
    assert found == {frozenset((a, b)) for a, some in plain_near(words).items() for b in some}
