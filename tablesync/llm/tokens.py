"""Token ids of whole texts, many texts at a time.

The tokenizer's pre-tokens are found for a whole batch at once with numpy, each
distinct pre-token is merged once by the tokenizer's vocabulary, and the ids are laid
out by a gather. The classes of characters used for that are those of the ranges in
``SAME_CLASSES``, where every code point was compared with the tokenizer's own
splitting; a text with any other character, or with the string of an added token such
as ``<|endoftext|>``, goes through the tokenizer as it is.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence

import numpy as np

BPE_FILE = "byte_bpe_50k.json"
# Pre-tokens kept per worker; beyond that the cache starts anew. Memory only, ids don't depend on it.
CACHE_WORDS = 1 << 18
# Ranges in which letters, numbers and white space agree with the tokenizer's pattern.
SAME_CLASSES = ((0x0, 0x530), (0x2010, 0x2065), (0x4E00, 0x9FEF), (0xAC00, 0xD7A4))
SPACE, LETTER, NUMBER, OTHER, END, UNKNOWN = range(6)
# The pattern's contractions.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
# What stands between two texts of a batch; it isn't a character.
BREAK = 0x110000


def tokenizer_path(name: str = BPE_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _classes() -> np.ndarray:
    import regex

    table = np.full(BREAK + 1, UNKNOWN, np.uint8)
    for first, stop in SAME_CLASSES:
        text = "".join(map(chr, range(first, stop)))
        table[first:stop] = OTHER
        for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
            table[[ord(c) for c in regex.findall(pattern, text)]] = kind
    table[BREAK] = END
    return table


def word_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of code points begin; every BREAK is one of its own, and the first and last point are BREAKs."""
    change = np.empty(len(points), bool)
    change[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:])
    change |= kinds == END
    is_space = kinds == SPACE
    after_space = np.zeros(len(points), bool)
    after_space[1:] = is_space[:-1]
    nonspace = ~is_space & (kinds != END)
    # A run begins a pre-token, unless a blank before it does.
    start = change.copy()
    start[1:] &= ~(nonspace[1:] & (points[:-1] == 0x20))
    # The last white space before a word is split from a run of it.
    last = np.zeros(len(points), bool)
    last[:-1] = is_space[:-1] & nonspace[1:]
    start |= last
    quotes = np.flatnonzero((points == 0x27) & start & (kinds == OTHER))
    quotes = quotes[kinds[quotes + 1] == LETTER] if len(quotes) else quotes
    for q in quotes:
        tail = "".join(chr(c) if c < BREAK else "\n" for c in points[q + 1 : q + 3])
        for c in CONTRACTIONS:
            if tail.startswith(c):
                start[q + 1 : q + 1 + len(c)] = False
                if kinds[q + 1 + len(c)] != END:
                    # A blank or another class begins its own run there anyway.
                    start[q + 1 + len(c)] |= kinds[q + 1 + len(c)] == LETTER
                break
    return np.flatnonzero(start)


class BatchTokenizer:
    """Ids of texts by the tokenizer in ``path``; one per worker process (see ``tokenizer``)."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        # The same vocabulary for single pre-tokens: the order of its ids is the order of its merges.
        plain = {c: b for b, c in _byte_alphabet().items()}
        self.added = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks = {bytes(plain[c] for c in t): i for t, i in self.whole.get_vocab().items() if t not in self.added}
        self.piece = tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})
        rng = np.random.default_rng(20)
        self.odd = rng.integers(0, 1 << 63, 2, np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = np.empty((2, 0), np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.check = np.zeros(1 << 12, np.uint64)
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _learn(self, words: list[str], hashes: np.ndarray, checks: np.ndarray) -> None:
        encode = self.piece._encode_single_piece
        ids = [encode(w) if w else [] for w in words]
        flat = np.array(list(itertools.chain.from_iterable(ids)), np.uint32)
        at, size = len(self.slots), np.array(list(map(len, ids)), np.int64)
        self.check, self.first, self.count = (_room(a, at + len(words)) for a in (self.check, self.first, self.count))
        self.pool = _room(self.pool, self.used + len(flat))
        self.check[at : at + len(words)] = checks
        self.count[at : at + len(words)] = size
        self.first[at : at + len(words)] = self.used + np.cumsum(size) - size
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.slots.update(zip(hashes.tolist(), range(at, at + len(words)), strict=True))

    def _hashes(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.diff(starts, append=len(points))
        longest = int(sizes.max())
        if longest > self.powers.shape[1]:
            self.powers = np.cumprod(np.repeat(self.odd[:, None], 2 * longest, 1), axis=1, dtype=np.uint64)
        within = np.arange(len(points)) - np.repeat(starts, sizes)
        value = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        one = np.add.reduceat(value * self.powers[0][within], starts)
        two = np.add.reduceat(value * self.powers[1][within], starts)
        return one, two, sizes

    def _slots(self, joined: str, points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The slot of every pre-token, those that are breaks; None if two pre-tokens share a hash."""
        starts = word_starts(points, kinds)
        one, two, sizes = self._hashes(points, starts)
        distinct, at, inverse = np.unique(one, return_index=True, return_inverse=True)
        if (two[at][inverse] != two).any():
            return None
        if len(self.slots) + len(distinct) > CACHE_WORDS:
            self._forget()
        keys = distinct.tolist()
        known = np.array([self.slots.get(h, -1) for h in keys], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            first = starts[at[new]]
            spans = zip(first.tolist(), (first + sizes[at[new]]).tolist(), strict=True)
            breaks = points[first] == BREAK
            words = ["" if b else joined[i:j] for (i, j), b in zip(spans, breaks.tolist(), strict=True)]
            known[new] = np.arange(len(self.slots), len(self.slots) + len(new))
            self._learn(words, distinct[new], two[at[new]])
        if (self.check[known] != two[at]).any():
            return None
        return known[inverse], points[starts] == BREAK

    def _whole_ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, texts: Sequence[str], with_ids: bool) -> tuple[np.ndarray | None, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = "\n".join(["", *texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        ends = np.cumsum([0] + [len(t) + 1 for t in texts])
        points[ends] = BREAK
        kinds = _classes()[points]
        odd = set((np.unique(np.searchsorted(ends, np.flatnonzero(kinds == UNKNOWN))) - 1).tolist())
        if any(t in joined for t in self.added):
            odd |= {i for i, text in enumerate(texts) if any(t in text for t in self.added)}
        if odd:
            return self._mixed(texts, odd, with_ids)
        found = self._slots(joined, points, kinds)
        if found is None:
            return self._mixed(texts, set(range(len(texts))), with_ids)
        slots, breaks = found
        sizes = self.count[slots]
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.diff(before[np.flatnonzero(breaks)])
        if not with_ids:
            return None, counts
        return self.pool[np.repeat(self.first[slots] - before[:-1], sizes) + np.arange(before[-1])], counts

    def _mixed(self, texts: Sequence[str], odd: set[int], with_ids: bool) -> tuple[np.ndarray | None, np.ndarray]:
        """Texts of which some, the ``odd``, go through the tokenizer as they are."""
        flat, counts = self._encode([t for i, t in enumerate(texts) if i not in odd], with_ids)
        if not with_ids:
            rest = iter(counts.tolist())
            each = [len(self._whole_ids(t)) if i in odd else next(rest) for i, t in enumerate(texts)]
            return None, np.array(each, np.int64)
        rest = iter(np.split(flat, np.cumsum(counts)[:-1]))
        parts = [self._whole_ids(t) if i in odd else next(rest) for i, t in enumerate(texts)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def ids(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        return self._encode(texts, True)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """How many ids each text has."""
        return self._encode(texts, False)[1]


def _room(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    return np.concatenate([a, np.zeros(max(size, 2 * len(a)) - len(a), a.dtype)])


def _byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def tokenizer(path: str) -> BatchTokenizer:
    """The worker's tokenizer, loaded once per process."""
    return BatchTokenizer(path)


def chunks(texts: Sequence[str], most: int = 1 << 19):
    """Slices of texts with about ``most`` characters each, one text at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(first, i)
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield slice(first, len(texts))
