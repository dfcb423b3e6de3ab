"""Near-duplicates: fast similarity sketches, banding, and an exact check on the whole sets.

A document's set holds its distinct shingles of ``words`` words, two if nothing else is said. Its sketch has ``COORDINATES``
places. In each of the first rounds every shingle is hashed into one place with a
value that grows with the round, and a place keeps its smallest; in the later rounds the
places that are still empty are filled one after another with the set's smallest hash.
So every coordinate fills, a set of many shingles after one or two rounds, and the share
of places at which two sketches agree is concentrated around the similarity as that
of independent draws. Bands of six coordinates make the candidates: a pair at the
threshold is missed with probability (1 - 0.8^6)^40 < 6e-6.

Equal sets are one class first, so copies are never compared. In a band's bucket
classes are compared with a centre, not each with each: the edge confirmed on whole sets
joins components. Then, against another centre for each bucket, and last of all, in
buckets that still hold several components, the pairs of different components alone. Of those
a pair is formed only if it can reach the threshold: with the shingles of each set in the
order of their frequency, rare ones first, similar sets have their first common shingle so early
in both that what follows can make up the overlap they need. So no pair that could join
components is left out, pairs within a component are never formed, and of a large group of near
copies only those pairs are that also share rare shingles. Joins on a bucket, a centre, a
shingle or a class are ones that Spark splits if they are hot.

Defined cases: null and empty texts, and texts without words, have an empty set and are
linked with nothing; a text with fewer words than a shingle is a set of all its words in a row; a null id is larger than all
others; rows that repeat an id are one document, whose row goes with its own set; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import dealt_anew, slices, whole_id, whole_text
from tablesync.llm.graph import components, stored
from tablesync.llm.tokens import chunks
from tablesync.session import run_folder

BANDS, ROWS = 40, 6
COORDINATES = BANDS * ROWS
SHARE = 80  # per cent
# Words of a shingle by op9's contract.
WORDS = 2

ONE, TWO, PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
IS_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * ONE)


def _in_a_row(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring words."""
    count = max(0, len(words) - width + 1)
    out = words[:count]
    for i in range(1, width):
        out = _mixed(out * ONE + words[i : i + count] * PAIR)
    return out


def shingle_sets(texts: list[bytes], width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of every text as 64-bit hashes."""
    data = np.frombuffer(b"\n" + b"\n".join(texts).lower() + b"\n", np.uint8)
    ends = np.cumsum([0] + [len(t) + 1 for t in texts])
    white = IS_WHITE[data]
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    sizes = np.flatnonzero(~white[:-1] & white[1:]) + 1 - starts
    longest = int(sizes.max())
    powers = np.cumprod(np.full(longest, TWO, np.uint64))
    place = np.flatnonzero(~white)
    first = np.cumsum(sizes) - sizes
    within = np.arange(len(place)) - np.repeat(first, sizes)
    words = _mixed(np.add.reduceat(BYTES[data[place]] * powers[within], first) + sizes.astype(np.uint64))
    shingles = _in_a_row(words, width)
    bounds = np.searchsorted(starts, ends)
    sets = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if 0 < j - i < width:
            sets.append(_mixed(_in_a_row(words[i:j], j - i) + PAIR))
        else:
            sets.append(np.unique(shingles[i : max(i, j - width + 1)]))
    return sets


def sketch(items: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of hashes."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    places = np.full(size, empty, np.uint64)
    for turn in range(2 * size):
        drawn = _mixed(items + np.uint64((turn + 1) * int(TWO) % (1 << 64)))
        value = (drawn >> np.uint64(32)) | np.uint64(turn << 32)
        if turn < size:
            at = ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)
            np.minimum.at(places, at.astype(np.int64), value)
            if (places != empty).all():
                break
        elif places[turn - size] == empty:
            places[turn - size] = value.min()
    return places


def band_keys(places: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = places.reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * ONE
    for i in range(ROWS):
        keys = _mixed(keys * PAIR + rows[:, i])
    return keys.view(np.int64)


def _signatures(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            sizes, names, keys = [], [], []
            marks = [hashlib.md5(t, usedforsecurity=False).digest() for t in texts]
            for part in chunks(texts):
                for items in shingle_sets(texts[part], words):
                    sizes.append(len(items))
                    names.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    keys.append(band_keys(sketch(items)) if len(items) else [])
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip((sizes, names, keys, marks), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n", "c", "keys", "of"])

    return run


def _similar(words: int):
    """The pairs of texts whose sets are similar; the second text comes many times in a row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, items = None, None
        for batch in slices(batches):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            links = []
            for part in chunks(left):
                sets = shingle_sets([t.encode("utf-8", "surrogatepass") for t in left[part]], words)
                for x, y, one, text in zip(a[part], b[part], sets, right[part], strict=True):
                    if y != last:
                        last, items = y, shingle_sets([text.encode("utf-8", "surrogatepass")], words)[0]
                    common = len(np.intersect1d(one, items, assume_unique=True))
                    if 100 * common >= SHARE * (len(one) + len(items) - common):
                        links.append((x, y))
            columns = [pa.array([link[i] for link in links], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def _sizes_fit(n: str, m: str) -> Column:
    return (100 * F.least(n, m) >= SHARE * F.greatest(n, m)).alias("_fit")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    folder = run_folder(docs.sparkSession, "near-dedup")
    rows = docs.select(whole_id(id_col).alias("id"), whole_text(text_col).alias("text"))
    signed = stored(
        rows.mapInArrow(_signatures(words), "id long, n long, c binary, keys array<long>, of binary"), f"{folder}/signed"
    )
    of_class = signed.where("n > 0").groupBy("c")
    # Rows of one id may have other texts, of other classes: a class's text is known by id and text name.
    place = F.min(F.struct("id", "of")).alias("place")
    classes = of_class.agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), place)
    classes = stored(classes, f"{folder}/classes")

    banded = classes.select("c", "n", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("key")
    members = stored(banded.join(dealt_anew(shared, "key"), "key"), f"{folder}/members")

    # The text of one row for each class that shares a bucket.
    needed = members.select("c").distinct().join(classes.select("c", "place.*"), "c")
    needed = needed.select("c", F.col("id").alias("at_id"), F.col("of").alias("at_of"))
    named = rows.withColumn("of", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    texts = named.join(needed, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("of") == F.col("at_of"))).select("c", "text")
    texts = stored(texts.groupBy("c").agg(F.first("text").alias("text")), f"{folder}/texts")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        left = pairs.join(texts.select(F.col("c").alias("a"), F.col("text").alias("left")), "a")
        both = left.join(texts.select(F.col("c").alias("b"), F.col("text").alias("right")), "b")
        return stored(both.select("a", "b", "left", "right").mapInArrow(_similar(words), "a binary, b binary"), f"{folder}/{name}")

    # First one centre for each class: the smallest class of its buckets.
    centres = members.groupBy("key").agg(F.min(F.struct("c", "n")).alias("z"))
    first = members.join(dealt_anew(centres, "key"), "key").where("c <> z.c").where(_sizes_fit("n", "z.n"))
    first = first.groupBy(F.col("c").alias("a")).agg(F.min("z.c").alias("b"))
    tried = stored(first, f"{folder}/pairs-1")
    edges = confirmed(tried, "edges-1")
    roots = components(edges, f"{folder}/roots-1")

    # Then a centre of its own for each bucket, then all pairs of different components.
    for turn in (2, 3):
        placed = members.join(roots.withColumnRenamed("node", "c"), "c", "left")
        placed = placed.withColumn("root", F.coalesce("root", "c"))
        several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        several = several.where("lo <> hi").select("key")
        placed = stored(placed.join(dealt_anew(several, "key"), "key"), f"{folder}/open-{turn}")
        if not placed.head(1):
            break
        if turn == 3:
            pairs = _reachable(placed.select("c", "n", "root").distinct(), texts, words, f"{folder}/first-common")
        else:
            drawn = F.struct(F.xxhash64("c", "key").alias("o"), "c", "n", "root")
            other = placed.groupBy("key").agg(F.min(drawn).alias("z"))
            pairs = placed.join(dealt_anew(other, "key"), "key").where("root <> z.root")
            pairs = pairs.where(_sizes_fit("n", "z.n"))
        # Of a pair the larger class is a, as in the pairs tried before.
        pairs = pairs.select(F.greatest("c", "z.c").alias("a"), F.least("c", "z.c").alias("b")).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), f"{folder}/pairs-{turn}")
        tried = tried.unionByName(pairs)
        edges = edges.unionByName(confirmed(pairs, f"edges-{turn}"))
        roots = components(edges, f"{folder}/roots-{turn}")

    linked = classes.select("c", "rep").join(roots.withColumnRenamed("node", "c"), "c", "left")
    linked = linked.withColumn("root", F.coalesce("root", "c"))
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(dealt_anew(least, "root"), "root").select(F.col("c").alias("of"), "component_id")
    out = signed.select("id", "n", "c").join(named, F.col("c") == F.col("of"), "left")
    group = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        group.alias("component_id"),
        F.col("id").eqNullSafe(group).alias("kept"),
    )


def _reachable(classes: DataFrame, texts: DataFrame, words: int, path: str) -> DataFrame:
    """Pairs of classes (``c``, ``z``) of different roots that may be similar, by their first common shingle.

    Any order of the shingles that all classes share would do; the rare ones first leaves the fewest pairs.
    """
    classes = classes.withColumn("o", F.xxhash64("c"))
    items = classes.select("c", "o").join(texts, "c").select("o", "text").mapInArrow(_shingle_rows(words), "o long, h long")
    often = items.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    known = items.join(dealt_anew(often, "h"), "h").groupBy("o").agg(
        F.sort_array(F.collect_list(F.struct("k", "h"))).alias("common")
    )
    placed = classes.join(dealt_anew(known, "o"), "o")
    # Shingles of no other class come first; they share nothing, but count as places. A similar set shares 4/5 at least.
    alone = F.col("n") - F.size("common")
    early = F.greatest(F.lit(0), F.floor(F.col("n") / 5) + 1 - alone)
    placed = placed.select(
        "c", "n", "root", alone.alias("alone"), F.slice("common", 1, early.cast("int")).alias("s")
    )
    rows = placed.select("c", "n", "root", "alone", F.posexplode("s").alias("i", "s"))
    rows = rows.select("c", "n", "root", F.col("s.h").alias("h"), (F.col("n") - F.col("alone") - F.col("i")).alias("rest"))
    rows = stored(rows, path)
    # Of each shingle's classes the largest component's are not paired with each other: they stand on one side only.
    sizes = rows.groupBy("h", "root").agg(F.count(F.lit(1)).alias("k"))
    most = sizes.groupBy("h").agg(F.max(F.struct("k", "root")).alias("m"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    small = rows.join(dealt_anew(most, "h"), "h").where("root <> m.root")
    others = rows.select("h", F.struct("c", "n", "root", "rest").alias("z"))
    # Similar sets share 4/9 of the sum of their sizes, all of it from here on.
    reach = 9 * F.least("rest", "z.rest") >= 4 * (F.col("n") + F.col("z.n"))
    return small.join(dealt_anew(others, "h"), "h").where("root <> z.root").where(reach).where(_sizes_fit("n", "z.n"))


def _shingle_rows(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            owners, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for part in chunks(texts):
                sets = shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts[part]], words)
                rows = [np.repeat(owners[part], [len(s) for s in sets]), np.concatenate(sets).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["o", "h"])

    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, one document for each group, with all of their columns."""
    # A name that none of the columns has.
    name = "_kept" + "_" * max(map(len, docs.columns))
    kept = near_groups(docs, id_col, text_col, words).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, whole_id(id_col).eqNullSafe(F.col(name))).select(*[F.col(f"`{c}`") for c in docs.columns])
