"""Grouping of spelling variants by an index of variable-length grams.

Words are the runs of letters of all texts, counted over all of them. Two words are near
if they differ by one inserted, deleted or replaced character.

* **Dictionary.** Grams of two characters, and of up to four where the shorter gram is frequent: only a frequent
  gram is extended. A word, with a mark before and behind it, is decomposed into the longest grams
  of the dictionary that start at each place, without those that lie within an earlier one.
* **Bound.** One change at a place touches the grams over it and those behind it that a gram of the changed word may
  cover. The largest such number over all places is the word's bound: two near words share
  all grams of either but for so many. So of any ``bound + 1`` grams of a word one is shared; each word
  enters the lists of its rarest ones only, and the first shared gram of two near words, in the order of rarity, is
  among these for both.
* **Lists.** A shared gram lies wholly before or wholly behind the change, so all of the word up to its end,
  or all from its start, is shared too: a list is named by the gram together with that side. Words of a list are
  merged by what is left on the other side with one character left out, which finds the near ones and no
  others. Lists longer than ``LIST_WORDS`` are merged by all tasks at once in the same way, one row for each place left out.
* A word whose bound leaves no gram enters the list of all such words; with two to four characters and words of
  six there is none.

The dictionary that goes to the executors has at most ``2 * HOT_GRAMS`` frequent grams and what extends them.
Near pairs leave a task as pairs; a word has at most as many as there are letters and places.

Defined cases: a null, empty or letterless text has no words; a null id counts as empty text where ids choose the changed runs; rows that
repeat an id or a whole row count each; of equally frequent near words the first in code-point order is the form; an empty table gives an
empty result; other columns are not read, whatever their names. A very long text is read in parts of a megabyte that end between
runs, and a run is a word however long.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import dealt_anew, slices
from tablesync.llm.graph import stored
from tablesync.session import run_folder

SHORTEST, LONGEST = 2, 4
# A gram in more words than this is frequent; of these the most frequent HOT_GRAMS of a length are extended.
FREQUENT = 200
HOT_GRAMS = 4096
LIST_WORDS = 4096
LEAST_POINTS, LEAST_COUNT = 6, 5
# A form is this many times as frequent as its variant.
FORM_RATIO = 5
# Every run whose hash this number divides loses a character.
CHANGED = 199
# Bytes of a text that are read at once, and distinct words a task counts before it hands them on. Memory only.
PART = 1 << 20
COUNTED = 1 << 18
BEGIN, END = "^", "$"

RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
# Where a text may be cut: no run and no character reaches across.
CUT = re.compile(rb"[^A-Za-z\x80-\xff]")


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """The runs of letters of a text, part by part."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + PART)
        stop = cut.start() if cut else len(text)
        yield RUN.findall(text[at:stop])
        at = stop


def _without(run: bytes, h: int) -> bytes:
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    changed: int = CHANGED,
    least_points: int = LEAST_POINTS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words that are long and frequent enough.

    With ``changed``, every run whose hash with the document's id that number divides loses one character, as the contract
    of the query wants; with 0 all runs count as they are.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: Counter = Counter()

        def batch():
            long = [(w.decode(), n) for w, n in counts.items() if w and len(w) - w.count(b"\xc3") >= least_points]
            counts.clear()
            columns = zip(*long, strict=True) if long else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64()), strict=True)], ["word", "n"])

        for some in slices(batches):
            for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for runs in _runs(text.lower()):
                    counts.update(runs)
                    if changed:
                        crc = zlib.crc32
                        for w in [w for w in set(runs) if not crc(w, seed) % changed]:
                            times = runs.count(w)
                            counts[w] -= times
                            counts[_without(w, crc(w, seed))] += times
                    if len(counts) > COUNTED:
                        yield batch()
        yield batch()

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    found = docs.select(F.col(f"`{id_col}`").cast("string").alias("_id"), text.alias("_text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_counts(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST) -> dict[str, int]:
    """The dictionary: each gram and how many words have it, counting places."""
    marked = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("m"))
    counts, hot = {}, None
    for size in range(shortest, longest + 1):
        places = F.expr(f"transform(sequence(1, length(m) - {size - 1}), i -> substring(m, i, {size}))")
        grams = marked.where(F.length("m") >= size).select(F.explode(places).alias("g"))
        if hot is not None:
            if not hot:
                break
            some = words.sparkSession.createDataFrame([(g,) for g in hot], "h string")
            grams = grams.join(F.broadcast(some), F.substring("g", 1, size - 1) == F.col("h"), "left_semi")
        found = grams.groupBy("g").count()
        counts.update({r["g"]: r["count"] for r in found.toLocalIterator()})
        frequent = found.where(F.col("count") > FREQUENT).orderBy(F.desc("count"), "g").limit(HOT_GRAMS)
        hot = [r["g"] for r in frequent.collect()]
    return counts


def decompose(marked: str, extended: set[str] | frozenset[str], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int]]:
    """Place and size of a word's grams; ``extended`` are the grams that longer ones of the dictionary begin with."""
    out, end = [], -1
    for at in range(len(marked) - shortest + 1):
        size = shortest
        while size < longest and at + size < len(marked) and marked[at : at + size] in extended:
            size += 1
        if at + size - 1 > end:
            out.append((at, size))
            end = at + size - 1
    return out


def affected(points: int, grams: list[tuple[int, int]], longest: int = LONGEST) -> int:
    """The most grams that one change of a marked word of ``points`` characters can touch."""
    most = 0
    for i in range(1, points):
        if i < points - 1:
            # The character at i is replaced or deleted.
            most = max(most, sum(a <= i < a + n or (a > i and a + n <= i + longest) for a, n in grams))
        # A character is inserted before i.
        most = max(most, sum(a < i < a + n or (a >= i and a + n < i + longest) for a, n in grams))
    return most


def list_names(word: str, counts: dict[str, int], extended: set[str] | frozenset[str]) -> Iterator[tuple[str, str]]:
    """Name of each list that a word enters, and what is left of the word there."""
    marked = BEGIN + word + END
    grams = decompose(marked, extended)
    bound = affected(len(marked), grams)
    if bound >= len(grams):
        yield "*", word
    order = sorted((counts[marked[a : a + n]], marked[a : a + n], a) for a, n in grams)
    for _, gram, at in order[: bound + 1]:
        stop = at + len(gram)
        if stop < len(marked):
            yield marked[:stop], marked[stop:-1]
        if at > 0:
            yield marked[at:], marked[1:at]


def left_out(rest: str) -> list[str]:
    """The rest with each character left out; the place goes along, so equal ones have it in common."""
    return [f"{i}:{rest[:i]}{rest[i + 1 :]}" for i in range(len(rest))]


def _near_in_list(rests: dict[str, str]) -> Iterator[tuple[str, str]]:
    """Near pairs of a list, each once; ``rests`` has each word under what is left of it."""
    same: dict[str, list[str]] = {}
    for rest, word in rests.items():
        for key in left_out(rest):
            same.setdefault(key, []).append(word)
        for shorter in {key.partition(":")[2] for key in left_out(rest)}:
            if shorter in rests:
                yield rests[shorter], word
    for members in same.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                yield a, b


def _merged_in_tasks(lists: DataFrame) -> DataFrame:
    """Near pairs of lists that a task can hold."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def pairs(rests: dict[str, str]):
            found = list(_near_in_list(rests)) if len(rests) > 1 else []
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

        name, rests = None, {}
        for batch in batches:
            for at, word, rest in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if at != name:
                    yield from pairs(rests)
                    name, rests = at, {}
                rests[rest] = word
        yield from pairs(rests)

    return lists.select("list", "word", "rest").repartition("list").sortWithinPartitions("list").mapInArrow(run, "a string, b string")


def _merged_by_all(lists: DataFrame) -> DataFrame:
    """Near pairs of lists of any length: words meet under what they leave out."""
    places = "transform(sequence(1, length(rest)), i -> struct(i AS at, concat(substring(rest, 1, i - 1), substring(rest, i + 1)) AS left))"
    out = lists.where(F.length("rest") > 0).select("list", "word", F.expr(f"inline({places})"))
    # At most one word for each letter has one place left out, so these groups are small whatever the list's length.
    same = out.groupBy("list", "at", "left").agg(F.sort_array(F.collect_set("word")).alias("words")).where(F.size("words") > 1)
    pair = "transform(slice(words, i + 1, size(words)), b -> struct(words[i - 1] AS a, b AS b))"
    replaced = same.select(F.expr(f"inline(flatten(transform(sequence(1, size(words) - 1), i -> {pair})))"))
    whole = lists.select("list", F.col("rest").alias("left"), F.col("word").alias("a"))
    longer = out.select("list", "left", F.col("word").alias("b")).distinct().join(dealt_anew(whole, "list", "left"), ["list", "left"])
    return replaced.union(longer.select("a", "b"))


def near_pairs(words: DataFrame, folder: str, list_words: int = LIST_WORDS) -> DataFrame:
    """``a`` and ``b``: all pairs of near words, each once."""
    counts = gram_counts(words)
    extended = frozenset({g[:-1] for g in counts if len(g) > SHORTEST})
    shared = words.sparkSession.sparkContext.broadcast((counts, extended))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(name, word, rest) for word in batch.column(0).to_pylist() for name, rest in list_names(word, *shared.value)]
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["list", "word", "rest"])

    lists = stored(words.select("word").mapInArrow(run, "list string, word string, rest string"), f"{folder}/lists")
    long = stored(lists.groupBy("list").count().where(F.col("count") > list_words).select("list"), f"{folder}/long")
    short = _merged_in_tasks(lists.join(long, "list", "left_anti"))
    pairs = short.union(_merged_by_all(lists.join(dealt_anew(long, "list"), "list", "left_semi")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()




def variant_groups(words: DataFrame, ratio: int = FORM_RATIO, list_words: int = LIST_WORDS) -> DataFrame:
    """For each (``word``, ``n``) its form, the root that its forms lead to, the number of near words and the form's count."""
    folder = run_folder(words.sparkSession, "spelling")
    words = stored(words, f"{folder}/words")
    pairs = stored(near_pairs(words, folder, list_words), f"{folder}/pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The least of (-n, word) is the most frequent near word, the first of equals.
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best")
    near = both.join(other, "other").groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.w")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    found = stored(found, f"{folder}/forms")
    # A form is ``ratio`` times as frequent as its variant, so the largest count bounds the steps to a root; each round doubles them.
    steps, largest = 1, found.agg(F.max("form_n")).head()[0] or 0
    while largest >= ratio**steps:
        steps += 1
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for turn in range((max(2, steps) - 2).bit_length()):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = stored(roots, f"{folder}/roots-{turn}")
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
