"""Swap-based packing: ids against the tokenizer, pieces that give back every document, and sequences few enough."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablesync.llm import swap_packing, word_tokens
from tablesync.llm.tokens import tokenizer_path

PATH = tokenizer_path(word_tokens.WORD_FILE)


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def ids_of(encode, text):
    return np.concatenate(list(encode.ids(text))).tolist()


def test_classes_agree_with_the_tokenizer(whole):
    """Every code point of the ranges: alone, within a word, beside a number and beside others."""
    encode = word_tokens.WordTokenizer(PATH)
    for first, stop in word_tokens.SAME_CLASSES:
        for p in range(first, stop, 1 if stop < 0x1000 else 97):
            for text in (chr(p), f"a{chr(p)}b", f"1{chr(p)}'S", f" {chr(p)}! 'LL"):
                assert ids_of(encode, text) == whole.encode(text, add_special_tokens=False).ids, (hex(p), text)


def test_ids_equal_the_tokenizer(whole, raw, monkeypatch):
    encode = word_tokens.WordTokenizer(PATH)
    texts = [r[1] or "" for r in raw]
    texts += ["A <|endoftext|>b <|startoftext|>", "é ñ", "İstanbul ΣΑΣ", "it's WE'LL ''s ''''ve'", "１２ ² ½", "\x1c\x85\xa0", "á" * 9]
    for part in (word_tokens.PART, 7):
        monkeypatch.setattr(word_tokens, "PART", part)
        monkeypatch.setattr(word_tokens, "CACHE_WORDS", 200)
        for text in texts:
            got = [i for p in word_tokens.parts(text, part) for i in encode._part(p).tolist()]
            assert got == whole.encode(text, add_special_tokens=False).ids, text[:50]


def test_short_texts_are_encoded_together(whole, raw, monkeypatch):
    texts = [r[1] or "" for r in raw] + ["A <|endoftext|>b", "İstanbul", "", "x " * 400, "it's new"]
    want = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    for most in (1, 60, 1 << 20):
        encode = word_tokens.WordTokenizer(PATH)
        assert [np.concatenate(list(ids)).tolist() for ids in encode.each(texts, most)] == want
    encode, learned = word_tokens.WordTokenizer(PATH), []
    monkeypatch.setattr(encode, "_learn", lambda: learned.append(len(encode.slots.new)) or type(encode)._learn(encode))
    assert len(list(encode.each(["some words", "and others", "some others", "new"]))) == 4
    assert learned == [5]


def test_parts_give_the_text_back():
    rng = random.Random(2)
    for _ in range(50):
        text = "".join(rng.choice("ab \n ") for _ in range(rng.randint(0, 80)))
        assert "".join(word_tokens.parts(text, 5)) == text


def check_pieces(rows, raw, whole, capacity):
    """Gapless sequences within the capacity; pieces that are the documents, cut only if they are longer."""
    want = Counter()
    for key, text in (r[:2] for r in raw):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[key, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_pack_gives_back_every_document(docs, raw, whole):
    rows = swap_packing.pack(docs).collect()
    used, total = check_pieces(rows, raw, whole, 2048)
    assert used == -(-total // 2048)


def test_small_capacity_and_groups(docs, raw, whole):
    for capacity, groups in ((64, 1 << 17), (64, 10), (1, 5)):
        rows = swap_packing.pack(docs, capacity=capacity, group_pieces=groups, with_ids=True).collect()
        check_pieces(rows, raw, whole, capacity)
        assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_document_of_exactly_full_sequences(spark, whole):
    text = " ".join(["the"] * 2047)
    rows = swap_packing.pack(spark.createDataFrame([(1, text), (2, text + " the"), (3, text * 2)], "doc_id long, text string")).collect()
    sizes = {i: sorted((r["piece"], r["length"]) for r in rows if r["doc_id"] == i) for i in (1, 2)}
    assert sizes == {1: [(0, 2048)], 2: [(0, 2048), (1, 1)]}


def test_empty_table(no_docs):
    assert swap_packing.pack(no_docs).collect() == []


def fewest(lengths, capacity):
    """The fewest sequences, by trying all ways."""
    best = len(lengths)

    def go(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for g in sorted({*gaps}):
            if g >= lengths[i]:
                rest = [*gaps]
                rest.remove(g)
                go(i + 1, [*rest, g - lengths[i]])
        go(i + 1, [*gaps, capacity - lengths[i]])

    go(0, [])
    return best


def test_search_beside_the_best_packing():
    rng = random.Random(11)
    fitted = searched = best = 0
    for _ in range(150):
        lengths = sorted((rng.randint(10, 60) for _ in range(rng.randint(4, 11))), reverse=True)
        sequences = swap_packing.Sequences(100)
        sequences.best_fit(lengths)
        fitted += len(sequences.bins)
        found = swap_packing.pack_lengths(lengths, 100)
        assert sorted(itertools.chain(*found)) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in found)
        searched += len(found)
        best += fewest(lengths, 100)
    assert best <= searched <= fitted
    assert searched - best <= 0.02 * best


def test_exchanges_increase_squared_fill():
    rng = random.Random(4)
    lengths = [rng.randint(300, 900) for _ in range(3000)]
    sequences = swap_packing.Sequences(2048)
    sequences.best_fit(lengths)
    before, squares = len(sequences.bins), [sum(f * f for f in sequences.fill)]
    move = sequences._move

    def watched(lengths, source, target):
        move(lengths, source, target)
        squares.append(sum(f * f for f in sequences.fill))

    sequences._move = watched
    sequences.search()
    # An exchange is two moves, what goes and what comes back.
    assert len(squares) > 10
    assert all(a < b for a, b in itertools.pairwise(squares[::2]))
    assert sum(f > 0 for f in sequences.fill) < before


def test_more_pieces_of_one_length_than_fit():
    assert len(swap_packing.pack_lengths([1024] * 1001)) == 501
    assert len(swap_packing.pack_lengths([1025] * 100)) == 100
    assert len(swap_packing.pack_lengths([1] * 5000)) == 3
    assert swap_packing.pack_lengths([]) == []
