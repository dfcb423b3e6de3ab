"""Ids, length histograms and packing beside the tokenizer itself."""

import collections
import random
import zlib

import numpy as np
import pytest

from tablesync.llm import packing, token_counts
from tablesync.llm.tokens import BatchTokenizer, tokenizer, tokenizer_path

HARD = [
    "", " ", "  ", "\n\n", "a  b", "a \n b", "it's we'll I've 's 'S ''s !'s '' 'll'll'd", "x y z　",
    "日本語 テスト", "don't\n\n\n  do", "a\tb\t\tc", "'", "'s", " 's", "12 34a5", "\x85q", "naïve café  ", "é <|endoftext|>",
    "’s “q” 中文 字了's", "\U0001f600 hi", "a\x00b", "'re're 'r e", "한국어 글", "नमस्ते दुनिया", "x" * 5000,
]


def encoded(t, text):
    return t.whole.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers():
    t, rng = tokenizer(tokenizer_path()), random.Random(1)
    letters = " \n\t'srteveml ld.a1!é中 ’"
    some = HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    flat, counts = t.ids(some)
    for text, ids in zip(some, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        assert ids.tolist() == encoded(t, text), text
    assert t.counts(some).tolist() == counts.tolist()


def test_added_tokens_are_found_as_by_the_tokenizer_alone():
    from tokenizers import Tokenizer

    alone, t = Tokenizer.from_file(tokenizer_path()), BatchTokenizer(tokenizer_path())
    mark = "<|endoftext|>"
    some = [f"a {mark} b", "a b", mark, mark * 3, f"{mark[:-1]}", "", f"it's{mark}\n\n é {mark}", mark[:5], mark[5:], *HARD]
    want = [alone.encode(text, add_special_tokens=False).ids for text in some]
    assert want[0] == [64, 220, 50256, 275]
    flat, counts = t.ids(some)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want
    assert t.counts(some).tolist() == list(map(len, want)) and t.counts([mark]).tolist() == [1]


def test_the_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("tablesync.llm.tokens.CACHE_WORDS", 50)
    t, rng = BatchTokenizer(tokenizer_path()), random.Random(2)
    for _ in range(20):
        text = " ".join(str(rng.random()) for _ in range(3))
        assert t.ids([text])[0].tolist() == encoded(t, text)


def test_character_classes_are_the_tokenizers():
    """Every code point of the fast ranges, beside a letter, a number and another character."""
    t = tokenizer(tokenizer_path())
    points = [c for a, b in ((0, 0x530), (0x2010, 0x2065), (0x4E00, 0x9FEF), (0xAC00, 0xD7A4)) for c in range(a, b)]
    some = ["".join(f"\n.a{chr(c)}1{chr(c)}!{chr(c)}" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    flat, counts = t.ids(some)
    for text, ids in zip(some, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        assert ids.tolist() == encoded(t, text)


def test_histogram(spark, docs, raw, no_docs):
    t = tokenizer(tokenizer_path())
    sizes = sorted(len(encoded(t, r[1] or "")) for r in raw)
    histogram = token_counts.length_histogram(docs)
    assert dict(map(tuple, histogram.collect())) == collections.Counter(sizes)
    totals = {r.n_tokens: r for r in token_counts.length_totals(histogram).collect()}
    assert sorted(totals) == sorted(set(sizes))
    for n, r in totals.items():
        assert r.docs_at_least == sum(s >= n for s in sizes) and r.tokens_at_least == sum(s for s in sizes if s >= n)
        assert r.truncated_tokens == sum(min(s, n) for s in sizes)
        assert r.share_at_most == pytest.approx(sum(s <= n for s in sizes) / len(sizes))
    limits = {r.context: r for r in token_counts.at_limits(histogram, [0, 7, 100, 10**6]).collect()}
    for n, r in limits.items():
        assert r.truncated_tokens == sum(min(s, n) for s in sizes) and r.docs_over == sum(s > n for s in sizes)
    middle = token_counts.quantiles(token_counts.length_totals(histogram), [0.5, 1.0]).collect()
    assert {r.share: r.n_tokens for r in middle} == {0.5: sizes[(len(sizes) + 1) // 2 - 1], 1.0: sizes[-1]}
    assert token_counts.length_totals(token_counts.length_histogram(no_docs)).count() == 0


def test_bands_add_up(spark):
    sizes = [0, 0, 1, 1023, 1024, 1025, 5000, 5000, 90_000]
    histogram = spark.createDataFrame(list(collections.Counter(sizes).items()), "n_tokens long, documents long")
    for r in token_counts.length_totals(histogram).collect():
        assert r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes)


def check_pieces(pieces, want):
    """Every id in one piece, sequences without gaps and with sizes that need no padding."""
    sequences, parts = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        parts[p.doc_id].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048 and at == s[0].sequence_size and at & (at - 1) == 0
    for key, ids in want.items():
        spans = collections.Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in parts.pop(key))
        for one in ids:
            at = 0
            while at < len(one):
                found = next(x for x in spans if x[0] == at and x[3] == len(one) and spans[x])
                assert zlib.crc32(one[at : at + found[1]].tobytes()) == found[2]
                spans[found] -= 1
                at += found[1]
            assert at == len(one)
        assert not sum(spans.values())
    assert not parts


def test_pack(docs, raw, no_docs):
    t, want = tokenizer(tokenizer_path()), collections.defaultdict(list)
    for r in raw:
        want[r[0]].append(np.array([*encoded(t, r[1] or ""), 1], "<u4"))
    pieces = packing.pack(docs).collect()
    assert sum(p.length for p in pieces) == sum(len(x) for v in want.values() for x in v)
    sequences = collections.defaultdict(int)
    for p in pieces:
        sequences[p.sequence_id] += p.length
    assert all(n & (n - 1) == 0 and n <= 2048 for n in sequences.values())
    single = docs.dropDuplicates(["doc_id"])
    kept = {r.doc_id: [np.array([*encoded(t, r.text or ""), 1], "<u4")] for r in single.collect()}
    check_pieces(packing.pack(single).collect(), kept)
    assert packing.pack(no_docs).count() == 0


def test_packer_on_many_lengths():
    rng = random.Random(3)
    for n in (1, 3, 500, 3000):
        packer, lengths, windows, blocks = packing.Packer(), {}, [], []
        for i in range(n):
            lengths[i] = int(rng.paretovariate(0.9) * 40) % 30_000 + 1
            packer.add(i, np.arange(lengths[i], dtype=np.uint32))
            if packer.tokens >= 1 << 19:
                blocks.append(packer.pack(False))
        blocks.append(packer.pack(True))
        windows = [w for b in blocks for w in b]
        seen = collections.defaultdict(list)
        for size, pieces in windows:
            assert sum(len(ids) for _, _, ids in pieces) == size and size & (size - 1) == 0
            for doc, start, ids in pieces:
                assert ids[0] == start
                seen[doc[0]].append((start, len(ids)))
        for i, length in lengths.items():
            at = 0
            for start, size in sorted(seen[i]):
                assert start == at
                at += size
            assert at == length


def test_step_groups_agree():
    rng, packer = random.Random(4), packing.Packer()
    for i in range(4000):
        packer.add(i, np.zeros(rng.randint(1, 4000), np.uint32))
    windows = packer.pack(True)
    tokens, cost = collections.Counter(), collections.Counter()
    for (size, pieces), group in zip(windows, packer.groups(windows), strict=True):
        tokens[group] += size
        cost[group] += sum(len(ids) ** 2 for _, _, ids in pieces)
    assert max(tokens.values()) <= 1.1 * min(tokens.values()) and max(cost.values()) <= 1.1 * min(cost.values())
