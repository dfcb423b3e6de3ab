"""Hierarchical packing of documents into sequences of several lengths.

A document's ids fill whole windows first. What is left is routed to the tier of
context sizes that holds it (2048, 1024, 512 or 256), anchors a window of that
size, and the window's gap is filled with pieces from the shorter tiers: whole
ones that fit, the largest first, then one that is cut. So windows are full, and
every id lies in one piece. What a task has left at its end goes into windows whose
sizes are powers of two, which need no padding either. Windows are dealt to
step groups tier by tier, by turns forth and back in the order of their cost, so that the
groups agree in tokens and in the sum of squared piece lengths.

Packing happens where a document is read: no shuffle, and a task holds
``BLOCK`` ids beside one batch. A lost task is run again on the same rows and makes
the same windows.

Defined cases: a null or empty text is its closing id alone; a null id is kept as null;
rows that repeat an id are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tablesync.llm.common import slices, whole_id, whole_text
from tablesync.llm.tokens import chunks, tokenizer, tokenizer_path

TIERS = (2048, 1024, 512, 256)
CLOSING_ID = 1
# Ids that a task gathers before it packs them, and the ids of a step group.
BLOCK = 1 << 21
GROUP_TOKENS = 1 << 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_size int, step_group long"
)


class Packer:
    """The open pieces of one task; a piece is (length, order, document, start, ids)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS):
        self.tiers = tiers
        self.group_tokens = group_tokens
        self.open: dict[int, list[tuple]] = {t: [] for t in tiers}
        self.windows: list[tuple[int, list[tuple]]] = []
        self.order = 0
        self.tokens = 0

    def _tier(self, length: int) -> int:
        return next(t for t in reversed(self.tiers) if length <= t)

    def _put(self, doc: tuple, start: int, ids: np.ndarray) -> None:
        self.order += 1
        insort(self.open[self._tier(len(ids))], (len(ids), self.order, doc, start, ids), key=lambda p: p[:2])

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Whole windows are done at once; the rest of the document is routed to its tier."""
        doc, longest = (doc_id, len(ids)), self.tiers[0]
        whole = len(ids) // longest * longest
        for start in range(0, whole, longest):
            self.windows.append((longest, [(doc, start, ids[start : start + longest])]))
        if whole < len(ids):
            self._put(doc, whole, ids[whole:])
        self.tokens += len(ids)

    def _fill(self, size: int, last: bool) -> list[tuple] | None:
        """One window from the open pieces of its tier and the shorter ones; None if they don't fill it."""
        shorter = [t for t in self.tiers if t < size]
        if not last and sum(p[0] for t in (size, *shorter) for p in self.open[t][-8:]) < size:
            if sum(p[0] for t in (size, *shorter) for p in self.open[t]) < size:
                return None
        pieces, gap = [], size
        while gap:
            for t in (size, *shorter) if not pieces else shorter:
                while gap and self.open[t]:
                    at = bisect_right(self.open[t], gap, key=lambda p: p[0]) - 1
                    if at < 0:
                        break
                    length, _, doc, start, ids = self.open[t].pop(at)
                    pieces.append((doc, start, ids))
                    gap -= length
                    if t == size:
                        break
            if not gap:
                break
            # Nothing whole fits: the smallest piece of the shortest tier that has one is cut.
            tier = next((t for t in reversed((size, *shorter)) if self.open[t]), None)
            if tier is None:
                break
            length, _, doc, start, ids = self.open[tier].pop(0)
            taken = min(gap, length)
            pieces.append((doc, start, ids[:taken]))
            if taken < length:
                self._put(doc, start + taken, ids[taken:])
            gap -= taken
        return pieces

    def pack(self, last: bool) -> list[tuple[int, list[tuple]]]:
        """All windows that the open pieces fill; at the ``last`` call also what is left, in powers of two."""
        for size in self.tiers:
            while self.open[size]:
                pieces = self._fill(size, False)
                if pieces is None:
                    break
                self.windows.append((size, pieces))
        if last:
            rest = [p for t in self.tiers for p in self.open[t]]
            self.open = {t: [] for t in self.tiers}
            left, queue = sum(p[0] for p in rest), [(doc, start, ids) for _, _, doc, start, ids in reversed(rest)]
            while left:
                size = min(1 << (left.bit_length() - 1), self.tiers[0])
                pieces, gap = [], size
                while gap:
                    doc, start, ids = queue.pop()
                    pieces.append((doc, start, ids[:gap]))
                    if len(ids) > gap:
                        queue.append((doc, start + gap, ids[gap:]))
                    gap -= len(pieces[-1][2])
                self.windows.append((size, pieces))
                left -= size
        done, self.windows, self.tokens = self.windows, [], 0
        return done

    def groups(self, windows: list[tuple[int, list[tuple]]]) -> list[int]:
        """A step group for each window: by size and cost, dealt forth and back."""
        count = max(1, sum(size for size, _ in windows) // self.group_tokens)
        cost = [sum(len(ids) ** 2 for _, _, ids in pieces) for _, pieces in windows]
        group = [0] * len(windows)
        for turn, i in enumerate(sorted(range(len(windows)), key=lambda i: (-windows[i][0], -cost[i], i))):
            row, column = divmod(turn, count)
            group[i] = column if row % 2 == 0 else count - 1 - column
        return group


def pack(
    docs: DataFrame,
    path: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    closing_id: int = CLOSING_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece; ``sequence_size`` is the tier's, ``step_group`` the group it trains in."""
    path = path or tokenizer_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        encode, packer, sequences, steps = tokenizer(path), Packer(tiers), 0, 0

        def rows(last: bool):
            nonlocal sequences, steps
            windows = packer.pack(last)
            if not windows:
                return
            groups = packer.groups(windows)
            out: list[list] = [[] for _ in range(9)]
            for (size, pieces), group in zip(windows, groups, strict=True):
                offset = 0
                for doc, start, ids in pieces:
                    row = (doc[0], start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc[1])
                    row += (base + sequences, offset, size, base + steps + group)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    offset += len(ids)
                sequences += 1
            steps += max(groups) + 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

        for batch in slices(batches):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in chunks(texts):
                flat, counts = encode.ids(texts[part])
                for key, ids in zip(keys[part], np.split(flat, np.cumsum(counts)[:-1]), strict=True):
                    packer.add(key, np.append(ids, np.uint32(closing_id)))
                if packer.tokens >= BLOCK:
                    yield from rows(False)
        yield from rows(True)

    return docs.select(whole_id(id_col).alias("_id"), whole_text(text_col).alias("_text")).mapInArrow(run, PIECES)
