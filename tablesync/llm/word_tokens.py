"""Token ids of texts by a tokenizer of whole words (lower case, white space dropped).

A text's words are found by one pattern, and each distinct word goes through the
tokenizer once; short texts are taken together, so new words come to it by the thousand. The pattern's classes hold for the ranges in ``SAME_CLASSES``, in which
every code point is compared with the tokenizer by the tests; a text with any other
character, or with the string of an added token, goes through the tokenizer as it is.
A very long text is read in parts that end at white space, where no token reaches across.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

WORD_FILE = "word_bpe_49k.json"
# Characters of a text that are encoded at once, and words kept per worker. Memory only, ids don't depend on them.
PART = 1 << 20
CACHE_WORDS = 1 << 19
# Ranges in which letters, numbers, white space and lower case agree with the tokenizer, one at a time and joined.
SAME_CLASSES = ((0x0, 0x130), (0x131, 0x180), (0x4E00, 0x9FA6))
# The mark of a token that ends a word, and the pattern's contractions.
WORD_END = "</w>"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _ranges(points: list[int]) -> str:
    """The inside of a character class."""
    out, first = [], None
    for i, p in enumerate(points):
        first = p if first is None else first
        if i + 1 == len(points) or points[i + 1] != p + 1:
            out.append(f"\\U{first:08x}-\\U{p:08x}")
            first = None
    return "".join(out)


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """The words of a text in lower case, and any character outside the ranges."""
    import regex

    points = [p for first, stop in SAME_CLASSES for p in range(first, stop)]
    text = "".join(map(chr, points))
    kinds = [[ord(c) for c in regex.findall(k, text)] for k in (r"\p{L}", r"\p{N}")]
    letters, numbers = map(_ranges, kinds)
    white = _ranges([0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0])
    words = "|".join([*CONTRACTIONS, f"[{letters}]+", f"[{numbers}]", f"[^{white}{letters}{numbers}]+"])
    return re.compile(words), re.compile(f"[^{_ranges(points)}]")


def parts(text: str, most: int = PART) -> Iterator[str]:
    """The text in parts of about ``most`` characters that end at white space."""
    at, white = 0, re.compile(r"[ \t\n]")
    while len(text) - at > most:
        found = white.search(text, at + most)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class _Slots(dict):
    """Words and their numbers; a word that is asked for and not there gets the next number and is put down as new."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class WordTokenizer:
    """Ids of texts by the tokenizer in ``path``; one per worker process (see ``word_tokenizer``)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words, self.odd = _patterns()
        # Every word's last token, and no other, is one that ends a word.
        size, ends = self.whole.get_vocab_size(), [i for t, i in self.whole.get_vocab().items() if t.endswith(WORD_END)]
        self.ends = np.zeros(size, bool)
        self.ends[ends] = True
        self._forget()

    def _forget(self) -> None:
        self.slots = _Slots()
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _learn(self) -> None:
        words, self.slots.new = self.slots.new, []
        (found,) = self.whole.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        at, need = len(self.slots) - len(words), self.used + len(ids)
        while len(self.first) < at + len(words):
            self.first, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.count))
        while len(self.pool) < need:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : need] = ids
        self.count[at : at + len(words)] = sizes = np.diff(stops, prepend=0)
        self.first[at : at + len(words)] = self.used + stops - sizes
        self.used = need

    def _looked_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after another, and how many come before each word and in all."""
        if len(self.slots) > CACHE_WORDS:
            self._forget()
        at = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        if self.slots.new:
            self._learn()
        sizes = self.count[at]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return self.pool[np.repeat(self.first[at] - before[:-1], sizes) + np.arange(before[-1])], before

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text; all words are looked up at once, and the new ones learned at once."""
        words, ends, whole = [], [0], {}
        for i, text in enumerate(texts):
            if self.odd.search(text) or any(t in text for t in self.added):
                whole[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                words += self.words.findall(text.lower())
            ends.append(len(words))
        ids, before = self._looked_up(words)
        ends = before[ends].tolist()
        return [whole[i] if i in whole else ids[ends[i] : ends[i + 1]] for i in range(len(texts))]

    def _part(self, text: str) -> np.ndarray:
        return self._together([text])[0]

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, part by part."""
        for part in parts(text):
            yield self._part(part)

    def each(self, texts: Iterable[str], most: int = PART) -> Iterator[Iterable[np.ndarray]]:
        """The ids of every text, part by part; texts of ``most`` characters in all are read together."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > most:
                yield from ([ids] for ids in self._together(held))
                held, size = [], 0
            if len(text) > most:
                yield self.ids(text)
            else:
                held.append(text)
                size += len(text)
        yield from ([ids] for ids in self._together(held))


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer, loaded once per process."""
    return WordTokenizer(path)
