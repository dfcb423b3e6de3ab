"""Removal of passages that occur more than once, by suffix arrays of difference covers.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.
The suffixes that can share such a string are brought together first: every window of
``length`` bytes is named by the smallest hash of its grams, so equal windows have
equal names, and neighbouring windows of one name make up a cell of about 280 bytes.
Names that occur once can't repeat; cells that are all alike under a name repeat
as a whole. All other cells are dealt out by name, equal cells once, and sorted
there by the difference-cover method: the triples of the positions that aren't
divisible by three are sorted and named, the string of names is sorted by recursion,
the rest is merged in by first letter and the rank behind it, and neighbours in the sorted order
are compared over their first ``length`` bytes. Sorting ends at that depth, five recursions down.

A passage that a third of all documents share is one cell, counted in every map
task, except at its ends, where each document has cells of its own under one name. Names
whose different cells exceed ``SORTED_BYTES`` are not gathered in one task: their
windows are dealt out one by one by a 128-bit hash. Tables between the steps are in the shared folder.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; rows that
repeat an id are documents of their own, so a repeated row loses all it has if it is long
enough; a null id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import dealt_anew, slices, whole_id, whole_text
from tablesync.llm.graph import stored
from tablesync.llm.near_dedup import BYTES, ONE, TWO, _mixed
from tablesync.session import run_folder

LENGTH, GRAM = 200, 32
# Bytes that one sort takes; three ranks and letters below 2^21 then fit into one 64-bit key.
SORTED_BYTES = 1 << 20
# Bytes that are hashed at a time, so that the arrays stay in a core's cache.
CHUNK = 1 << 18
SHIFT = np.int64(21)

CELLS = "id long, of binary, start int, windows int, name long, content long, periodic boolean"
_tables: dict[int, np.ndarray] = {}


def _powers(size: int, base: np.uint64) -> np.ndarray:
    """The powers of an odd base modulo 2^64, kept for the worker's life."""
    known = _tables.get(int(base))
    if known is None or len(known) < size:
        known = np.ones(max(size, CHUNK) * 2, np.uint64)
        known[1:] = base
        _tables[int(base)] = known = np.cumprod(known)
    return known[:size]


def _sums(data: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a polynomial hash, and the factors that make its differences independent of their place."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * _powers(len(data), base), out=sums[1:])
    return sums, _powers(len(data) + 1, inverse)


def _over(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The smallest or largest of every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        values, done = pick(values[:-done], values[done:]), 2 * done
    return pick(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def cells_of(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Cells of texts that lie one after another in ``data``: text, start in it, windows, name, content's hash, periodic.

    Periodic says that a cell's name may stand in it twice, so that its own windows may be equal.
    """
    starts, sizes = bounds[:-1], np.diff(bounds)
    nothing = np.zeros(0, np.int64)
    if not (sizes >= length).any():
        return nothing, nothing, nothing, nothing, nothing, np.zeros(0, bool)
    sums, factors = _sums(data, TWO)
    grams = _mixed((sums[gram:] - sums[:-gram]) * factors[: len(data) - gram + 1])
    names = _over(grams, length - gram + 1, np.minimum)

    inside = np.zeros(len(names) + 1, np.int8)
    long = sizes >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, bounds[1:][long] - length + 1, -1)
    valid = np.cumsum(inside[:-1]).astype(bool)
    begin = valid.copy()
    begin[1:] &= (names[1:] != names[:-1]) | ~valid[:-1]
    begin[starts[long]] = True
    first = np.flatnonzero(begin)
    text = np.searchsorted(bounds, first, "right") - 1
    # A cell ends where the next begins or with the last window of its text.
    windows = np.minimum(np.append(first[1:], len(names)), bounds[text + 1] - length + 1) - first

    ends = first + windows - 1 + length
    content = _mixed((sums[ends] - sums[first]) * factors[first] + windows.astype(np.uint64) * ONE)

    # Grams that are the smallest of some window; two equal ones side by side are where a name repeats.
    width = length - gram + 1
    padded = np.concatenate([np.zeros(width - 1, np.uint64), names, np.zeros(width - 1, np.uint64)])
    picked = np.flatnonzero(_over(padded, width, np.maximum) == grams)
    again = picked[:-1][(grams[picked[1:]] == grams[picked[:-1]]) & (picked[1:] - picked[:-1] < length)]
    periodic = np.zeros(len(first), bool)
    if len(again):
        at = np.searchsorted(first, again, "right") - 1
        for shift in (-1, 0, 1):
            near = np.clip(at + shift, 0, len(first) - 1)
            periodic[near[names[first[near]] == grams[again]]] = True
    return text, first - starts[text], windows, names[first].view(np.int64), content.view(np.int64), periodic


def _parts(texts: list[bytes]) -> Iterator[slice]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(first, i)
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield slice(first, len(texts))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])


def suffix_ranks(letters: np.ndarray, depth: int) -> np.ndarray:
    """For every position the number of suffixes that are smaller; equal only if equal for ``depth`` letters or more.

    Letters are positive and, like positions, below 2^21.
    """
    n = len(letters)
    if depth <= 1 or n < 4:
        if n < 4:
            suffixes = [tuple(letters[i:].tolist()) for i in range(n)]
            return np.array([sum(x < y for x in suffixes) for y in suffixes], np.int64)
        return np.searchsorted(np.sort(letters), letters)
    s = np.concatenate([letters, np.zeros(4, np.int64)])
    # With a dummy behind the last letter where the first class would end without a zero.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triples = (s[sample] << (2 * SHIFT)) | (s[sample + 1] << SHIFT) | s[sample + 2]
    distinct, names = np.unique(triples, return_inverse=True)
    ranks = names if len(distinct) == len(sample) else suffix_ranks(names + 1, -(-depth // 3) + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = ranks + 1

    zero, one = np.arange(0, n, 3), np.arange(1, n, 3)
    by_one, of_one = (s[zero] << SHIFT) | rank[zero + 1], (s[one] << SHIFT) | rank[one + 1]
    by_two = (s[zero] << (2 * SHIFT)) | (s[zero + 1] << SHIFT) | rank[zero + 2]
    of_two = (s[two] << (2 * SHIFT)) | (s[two + 1] << SHIFT) | rank[two + 2]
    sorted_by_one, sorted_by_two = np.sort(by_one), np.sort(by_two)
    smaller = np.empty(n, np.int64)
    smaller[zero] = (
        np.searchsorted(sorted_by_one, by_one)
        + np.searchsorted(np.sort(of_one), by_one)
        + np.searchsorted(np.sort(of_two), by_two)
    )
    # Among the sample itself the ranks say how many are smaller; a dummy isn't counted.
    met = np.bincount(rank[np.concatenate([one, two])], minlength=n + 5)
    before = np.cumsum(met) - met
    smaller[one] = before[rank[one]] + np.searchsorted(sorted_by_one, of_one)
    smaller[two] = before[rank[two]] + np.searchsorted(sorted_by_two, of_two)
    return smaller


def repeated_windows(texts: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """Per text the starts of its windows that occur twice or more; a text stands ``counts`` times."""
    data, bounds = _joined(texts)
    place = np.arange(len(data))
    text = np.searchsorted(bounds, place, "right") - 1
    valid = place + length <= bounds[text + 1]
    again = valid & (np.array(counts)[text] > 1)
    order = np.argsort(suffix_ranks(data.astype(np.int64) + 1, length), kind="stable")
    order = order[valid[order]]
    a, b = order[:-1], order[1:]
    # Eight bytes at a time, the last eight where the length isn't a multiple.
    words = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8).copy().view(np.uint64)[:, 0]
    for step in [*range(0, length - 8, 8), length - 8]:
        same = words[a + step] == words[b + step]
        a, b = a[same], b[same]
    again[a] = True
    again[b] = True
    hits = np.split(np.flatnonzero(again), np.searchsorted(np.flatnonzero(again), bounds[1:-1]))
    return [h - s for h, s in zip(hits, bounds[:-1], strict=True)]


def _runs(hits: np.ndarray) -> tuple[list[int], list[int]]:
    """Runs of neighbouring numbers as firsts and stops."""
    if not len(hits):
        return [], []
    cut = np.flatnonzero(np.diff(hits) > 1)
    return hits[np.append(0, cut + 1)].tolist(), (hits[np.append(cut, len(hits) - 1)] + 1).tolist()


def _cells(length: int, gram: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = np.array(batch.column(0).fill_null(0).to_numpy(), np.int64)
            texts, places = batch.column(2).to_pylist(), np.arange(batch.num_rows)
            for part in _parts(texts):
                text, *found = cells_of(*_joined(texts[part]), length, gram)
                if not len(text):
                    continue
                key = pa.array(ids[part][text], pa.int64(), mask=~known[part][text])
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                columns = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(found, kinds, strict=True)]
                names = ["id", "of", "start", "windows", "name", "content", "periodic"]
                of = batch.column(1).take(pa.array(places[part][text]))
                yield pa.RecordBatch.from_arrays([key, of, *columns], names)

    return run


def _extracted(batches: Iterator) -> Iterator:
    """The bytes of the cells wanted from each document."""
    import pyarrow as pa

    for batch in slices(batches):
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        out: list[list] = [[], [], [], []]
        for text, wanted in rows:
            for w in wanted:
                row = (w["name"], w["content"], w["n"], text[w["start"] : w["start"] + w["size"]])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["name", "content", "n", "bytes"])


RUNS = "name long, content long, firsts array<int>, stops array<int>"


def _run_batch(rows: list[tuple], length: int):
    import pyarrow as pa

    hits = repeated_windows([r[3] for r in rows], [r[2] for r in rows], length)
    found = [(r[0], r[1], *_runs(h)) for r, h in zip(rows, hits, strict=True) if len(h)]
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    columns = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["name", "content", "firsts", "stops"])


def _sorted_cells(length: int, most: int):
    """Cells sorted by name: as many names at a time as one sort takes."""

    def run(batches: Iterator) -> Iterator:
        rows, size, last = [], 0, None
        for batch in slices(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[0] != last and size and size + len(row[3]) > most // 2:
                    yield _run_batch(rows, length)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
                last = row[0]
        if rows:
            yield _run_batch(rows, length)

    return run


def _windows(length: int):
    """Every window of a cell by a 128-bit hash."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            for name, content, n, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = np.frombuffer(data, np.uint8)
                hashes = []
                for base in (TWO, ONE):
                    sums, factors = _sums(data, base)
                    count = len(data) - length + 1
                    hashes.append(_mixed((sums[length:] - sums[:-length]) * factors[:count]).view(np.int64))
                columns = [
                    pa.array(hashes[0], pa.int64()),
                    pa.array(hashes[1], pa.int64()),
                    pa.array(np.full(count, name), pa.int64()),
                    pa.array(np.full(count, content), pa.int64()),
                    pa.array(np.arange(count), pa.int32()),
                    pa.array(np.full(count, n), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["w1", "w2", "name", "content", "at", "n"])

    return run


def _cut(length: int):
    """What is left of every text, from the runs of windows that repeat."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            sizes, removed, spans, left = [], [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts, at, gone, count = [], 0, 0, 0
                for first, stop in sorted((r["first"], r["stop"]) for r in runs or ()):
                    stop += length - 1
                    if first > at or not count:
                        parts.append(text[at:first])
                        count += 1
                        gone += stop - first
                    else:
                        gone += max(0, stop - at)
                    at = max(at, stop)
                parts.append(text[at:])
                sizes.append(len(text))
                removed.append(gone)
                spans.append(count)
                left.append(b"".join(parts))
            columns = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
            shas = pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, shas, pa.array(left, pa.binary())], names)

    return run


def text_name(text: Column) -> Column:
    """128 bits that stand for a text among the rows of one id; many millions may share a null or hot id."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def drop_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    sorted_bytes: int = SORTED_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the ``kept`` bytes."""
    folder = run_folder(docs.sparkSession, "suffix-dedup")
    text = whole_text(text_col)
    rows = docs.select(whole_id(id_col).alias("id"), text_name(text).alias("of"), F.encode(text, "UTF-8").alias("text"))
    cells = rows.where(F.length("text") >= length).mapInArrow(_cells(length, gram), CELLS)

    # What is known of a name: how often it occurs, and whether all of its cells are alike.
    names = cells.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("content").alias("lo"),
        F.max("content").alias("hi"),
        F.max(F.when(F.col("periodic"), 1).otherwise(0)).alias("periodic"),
    )
    names = names.where("n > 1 or periodic = 1")
    names = names.select("name", ((F.col("lo") != F.col("hi")) | (F.col("periodic") == 1)).alias("mixed"))
    shared = cells.drop("periodic").join(dealt_anew(names, "name"), "name")
    shared = stored(shared.select("id", "of", "start", "windows", "name", "content", "mixed"), f"{folder}/shared")

    place = F.struct("id", "of", "start", "windows").alias("place")
    mixed = shared.where("mixed").groupBy("name", "content")
    mixed = stored(mixed.agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")), f"{folder}/mixed")
    large = mixed.groupBy("name").agg(F.sum(F.col("place.windows") + length - 1).alias("size"))
    large = stored(large.where(F.col("size") > sorted_bytes).select("name"), f"{folder}/large")

    cell = F.struct(
        "name", "content", "n", F.col("place.start").alias("start"), (F.col("place.windows") + length - 1).alias("size")
    )
    wanted = mixed.groupBy(F.col("place.id").alias("at_id"), F.col("place.of").alias("at_of"))
    wanted = wanted.agg(F.collect_list(cell).alias("wanted"))
    here = F.col("id").eqNullSafe(F.col("at_id")) & (F.col("of") == F.col("at_of"))
    # Of rows that repeat an id with one text any is as good: equal cells are taken once below.
    found = rows.join(wanted, here).select("text", "wanted")
    bytes_of = found.mapInArrow(_extracted, "name long, content long, n long, bytes binary")
    bytes_of = stored(bytes_of, f"{folder}/bytes")

    in_sort = bytes_of.join(large, "name", "left_anti").repartition("name").sortWithinPartitions("name", "content")
    runs = in_sort.dropDuplicates(["name", "content"]).sortWithinPartitions("name", "content")
    runs = runs.select("name", "content", "n", "bytes").mapInArrow(_sorted_cells(length, sorted_bytes), RUNS)
    by_window = bytes_of.join(dealt_anew(large, "name"), "name").dropDuplicates(["name", "content"])
    by_window = by_window.select("name", "content", "n", "bytes")
    windows = by_window.mapInArrow(_windows(length), "w1 long, w2 long, name long, content long, at int, n long")
    often = windows.groupBy("w1", "w2").agg(F.sum("n").alias("_n")).where("_n > 1").select("w1", "w2")
    hits = windows.join(dealt_anew(often, "w1", "w2"), ["w1", "w2"]).groupBy("name", "content")
    hits = hits.agg(F.sort_array(F.collect_list("at")).alias("at"))
    # Neighbouring windows are one run.
    firsts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1))
    lasts = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1))
    hits = hits.select("name", "content", firsts.alias("firsts"), F.transform(lasts, lambda x: x + 1).alias("stops"))
    runs = stored(runs.unionByName(hits), f"{folder}/runs")

    alike = shared.where("not mixed").select("id", "of", F.col("start").alias("first"), (F.col("start") + F.col("windows")).alias("stop"))
    runs = runs.select("name", "content", F.arrays_zip("firsts", "stops").alias("run"))
    apart = shared.where("mixed").join(runs, ["name", "content"]).select("id", "of", "start", F.explode("run").alias("run"))
    apart = apart.select("id", "of", (F.col("start") + F.col("run.firsts")).alias("first"), (F.col("start") + F.col("run.stops")).alias("stop"))
    # Each of the rows that repeat an id and a text brings the same runs; a text has them once.
    gone = alike.unionByName(apart).groupBy(F.col("id").alias("at_id"), F.col("of").alias("at_of"))
    gone = gone.agg(F.collect_set(F.struct("first", "stop")).alias("gone"))
    return rows.join(gone, here, "left").select("id", "text", "gone").mapInArrow(
        _cut(length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
