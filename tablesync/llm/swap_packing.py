"""Packing of whole documents into as few sequences as possible, by swap-based local search.

A document's ids are encoded where it is read; what goes on is one narrow row for each
piece: its place in the document, its length and a checksum. Pieces that fill a sequence
are done. The others are dealt at random into groups of about ``GROUP_PIECES``, so that a
group holds the lengths of the whole table and wastes less than one sequence more than
the whole table would. A group is packed in one task: best fit, longest first, and then local search.
Two underfull sequences exchange a piece for nothing, for another, or one for two, where that moves
ids from the emptier to the fuller one. Each exchange increases the sum of squared
fills, so the search ends; a sequence that has become empty goes. The search stops early
at the bound that no packing can beat, the number of ids over the capacity.

The groups come from a table in the shared folder, so a lost task packs the same rows in the same way again.

Defined cases: a null or empty text is its closing id alone; a null id is kept as null; rows that
repeat an id, or a whole row, are packed each; pieces of one length are taken in the order of the table; an
empty table gives an empty result; other columns are not read, whatever their names. A very long text is
encoded in parts of 2^20 characters, and a task holds one of them and less than two sequences of its ids; shorter texts
are encoded together up to as many characters.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import slices, whole_id, whole_text
from tablesync.llm.graph import stored
from tablesync.llm.tokens import tokenizer_path
from tablesync.llm.word_tokens import WORD_FILE, word_tokenizer
from tablesync.session import run_folder

CAPACITY = 2048
CLOSING_ID = 0
# Pieces that one task packs.
GROUP_PIECES = 1 << 17
# How many fuller sequences a sequence is compared with in a round, and the rounds of a search. Effort only.
PARTNERS = 64
ROUNDS = 8

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Sequences:
    """Pieces in sequences of one capacity; a sequence is a map from a length to the pieces that have it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[dict[int, list[int]]] = []
        self.fill: list[int] = []

    def best_fit(self, lengths: list[int]) -> None:
        """Every piece, longest first, into the fullest sequence that holds it."""
        by_gap: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        gaps = 0
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            n = lengths[i]
            wide = gaps >> n
            if wide:
                gap = n + (wide & -wide).bit_length() - 1
                b = by_gap[gap].pop()
                if not by_gap[gap]:
                    gaps ^= 1 << gap
            else:
                gap, b = self.capacity, len(self.bins)
                self.bins.append({})
                self.fill.append(0)
            self.bins[b].setdefault(n, []).append(i)
            self.fill[b] += n
            by_gap[gap - n].append(b)
            gaps |= 1 << (gap - n)

    def _exchange(self, a: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """Lengths that ``b`` gives and gets, so that the fuller ``a`` gains as much as it can; None if it can't gain."""
        gap, give, take = self.capacity - self.fill[a], sorted(self.bins[b]), sorted(self.bins[a])
        best, found = 0, None

        def better(out: tuple[int, ...], into: tuple[int, ...]) -> bool:
            nonlocal best, found
            gain = sum(out) - sum(into)
            if best < gain <= gap:
                best, found = gain, (out, into)
            return best == gap

        def largest(some: list[int], most: int) -> int | None:
            at = bisect_right(some, most) - 1
            return some[at] if at >= 0 else None

        n = largest(give, gap)
        if n is not None and better((n,), ()):
            return found
        for n in take:
            other = largest(give, n + gap)
            if other is not None and better((other,), (n,)):
                return found
        for i, n in enumerate(give):
            # Two of the emptier one's for one of the fuller one's; the smallest of those that leave room.
            for m in give[i:]:
                if m == n and len(self.bins[b][n]) < 2:
                    continue
                at = bisect_right(take, n + m - gap - 1)
                if at < len(take) and better((n, m), (take[at],)):
                    return found
        for i, n in enumerate(take):
            for m in take[i:]:
                if m == n and len(self.bins[a][n]) < 2:
                    continue
                other = largest(give, n + m + gap)
                if other is not None and better((other,), (n, m)):
                    return found
        return found

    def _move(self, lengths: tuple[int, ...], source: int, target: int) -> None:
        for n in lengths:
            some = self.bins[source][n]
            self.bins[target].setdefault(n, []).append(some.pop())
            if not some:
                del self.bins[source][n]
            self.fill[source] -= n
            self.fill[target] += n

    def search(self, partners: int = PARTNERS, rounds: int = ROUNDS) -> None:
        """Exchanges between underfull sequences until none helps, the bound is met or the rounds are over."""
        bound = -(-sum(self.fill) // self.capacity)
        used = sum(f > 0 for f in self.fill)
        for _ in range(rounds):
            underfull = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda b: (self.fill[b], b))
            changed = False
            for at, b in enumerate(underfull):
                # The fullest sequences have the least to gain; those next to this one in fill have the widest gaps.
                for a in underfull[at + 1 : at + 1 + partners]:
                    while used > bound and self.capacity > self.fill[a] >= self.fill[b] > 0:
                        exchange = self._exchange(a, b)
                        if exchange is None:
                            break
                        self._move(exchange[0], b, a)
                        self._move(exchange[1], a, b)
                        changed = True
                        used -= self.fill[b] == 0
                if used <= bound:
                    return
            if not changed:
                return


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """The pieces of each sequence, as positions in ``lengths``."""
    sequences = Sequences(capacity)
    sequences.best_fit(lengths)
    sequences.search()
    return [[i for n in sorted(b, reverse=True) for i in b[n]] for b in sequences.bins if b]


def encoded_pieces(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    closing_id: int = CLOSING_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of a document; with its ids, if they are wanted."""
    path = path or tokenizer_path(WORD_FILE)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
        names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids
        encode, rows = word_tokenizer(path), []

        def batch_of(rows: list[tuple]):
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def piece(key, number: int, ids: np.ndarray) -> tuple:
            row = (key, number, number * capacity, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            return (*row, ids.tolist()) if with_ids else row

        for batch in slices(batches):
            for key, parts in zip(batch.column(0).to_pylist(), encode.each(batch.column(1).to_pylist()), strict=True):
                held, number = np.zeros(0, np.uint32), 0
                for ids in parts:
                    held = np.concatenate([held, ids])
                    # What is held at the end goes with the closing id, so a full piece waits for one id more.
                    while len(held) > capacity:
                        rows.append(piece(key, number, held[:capacity]))
                        held, number = held[capacity:], number + 1
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
                held = np.append(held, np.uint32(closing_id))
                for first in range(0, len(held), capacity):
                    rows.append(piece(key, number, held[first : first + capacity]))
                    number += 1
            if rows:
                yield batch_of(rows)
                rows = []

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(whole_id(id_col).alias("_id"), whole_text(text_col).alias("_text")).mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``row``, ``sequence_id`` and ``offset`` for each (``row``, ``length``); ``row`` names a piece."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["row", "sequence_id", "offset"]

        def packed(group: int, rows: list[int], lengths: list[int]):
            where, sequence, offset = [], [], []
            for number, members in enumerate(pack_lengths(lengths, capacity)):
                at = 0
                for i in members:
                    where.append(rows[i])
                    sequence.append((group << 32 | number) * 2)
                    offset.append(at)
                    at += lengths[i]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (where, sequence, offset)], names)

        group, rows, lengths = None, [], []
        for batch in batches:
            for g, row, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if g != group:
                    if rows:
                        yield packed(group, rows, lengths)
                    group, rows, lengths = g, [], []
                rows.append(row)
                lengths.append(n)
        if rows:
            yield packed(group, rows, lengths)

    short = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))
    short = short.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g"), "row", "length")
    dealt = short.repartition(groups, "g").sortWithinPartitions("g", "row")
    full = pieces.where(F.col("length") == capacity)
    full = full.select("row", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.mapInArrow(run, "row long, sequence_id long, offset long").union(full)


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    closing_id: int = CLOSING_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row for each piece of a document with its sequence and its place there; with its ids, if they are wanted."""
    folder = run_folder(docs.sparkSession, "swap-packing")
    pieces = encoded_pieces(docs, path, capacity, closing_id, id_col, text_col, with_ids)
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), f"{folder}/pieces")
    return pieces.join(place(pieces.select("row", "length"), capacity, group_pieces), "row").drop("row")
