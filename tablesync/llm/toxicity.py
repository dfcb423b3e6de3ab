"""Toxicity scores by a classifier that is regularised with counterfactuals.

Features are the words of the whole text and their beginnings (stems take many
endings). Those that occur more often in toxic documents than chance can explain are chosen
from counts over the training rows, beside the identity terms: chance brings so many of a feature's n rows
to the toxic ones with a probability of exp(-n D) at most, D being the divergence of the feature's toxic share from
the share of all rows (Chernoff), and that times the number of features tried is kept under ``by_chance``. So the
test asks for no share of the toxic rows and works for rare words and any share of toxic rows. Every training row that
mentions an identity term has a twin in which the terms are swapped within their
group; the loss adds the squared difference of the two scores before the
sigmoid, so that a neutral mention of one group weighs as that of another and false
positives on such mentions go down.

Fitting is bounded: at most ``MAX_ROWS`` labelled rows (the smallest hashes of
their ids, so a rerun takes the same), at most ``MAX_FEATURES`` features, those of the strongest evidence. These
bounds, ``LEAST_ROWS`` and ``BY_CHANCE`` are parameters. Scoring reads every document where it lies, without a shuffle.

Defined cases: a null text is empty; an empty text has the score of the intercept;
rows that repeat an id are scored each; an id with several labels is toxic if one
says so; a null id is never held out and has no label; without labelled rows every
score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import slices, whole_id, whole_text
from tablesync.llm.graph import stored
from tablesync.session import run_folder

MAX_ROWS = 20_000
MAX_FEATURES = 2048
FOLDS = 5
# Features that a task counts before it hands on what it has.
HELD_FEATURES = 100_000
BEGINNINGS = (4, 5, 6)
# A feature is in this many training rows; so many features may be chosen by chance alone.
LEAST_ROWS = 4
BY_CHANCE = 1.0
STEPS, RIDGE, PAIRING = 600, 2e-5, 1.0

# Groups of terms that may stand for each other in a sentence.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male", "transgender"),
    ("gay", "lesbian", "bisexual", "heterosexual", "straight"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab", "mexican", "chinese"),
    ("deaf", "blind", "disabled"),
    ("old", "young"),
)

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Whole words, and beginnings marked by a star."""
    found = set(words)
    for n in BEGINNINGS:
        found.update(w[:n] + "*" for w in words if len(w) >= n)
    return found


def swapped(words: set[str], groups: tuple[tuple[str, ...], ...]) -> set[str] | None:
    """The words with every identity term changed for the next of its group; None if there is no term."""
    turn = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if not any(w in turn for w in words):
        return None
    return {turn.get(w, w) for w in words}


@dataclass(frozen=True)
class Model:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def scorer(self) -> Callable[[str], float]:
        weight = dict(zip(self.features, self.weights, strict=True))
        shortest = min(BEGINNINGS)
        # A word whose first letters begin no feature needs no further look.
        begins = {f.rstrip("*")[:shortest] for f in self.features}

        def score(text: str) -> float:
            near = {w for w in words_of(text) if w[:shortest] in begins}
            found = features_of(near) if near else ()
            total = self.intercept + sum(sorted(weight[f] for f in found if f in weight))
            return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))

        return score


def held_out(key: Column) -> Column:
    """Whether the id's CRC-32 leaves no rest by the number of folds."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold, one for each different text."""
    known = labels.select(whole_id("doc_id").alias("_of"), F.col("toxic").cast("int").alias("_y"))
    known = known.where(F.col("_y").isNotNull() & F.col("_of").isNotNull() & ~held_out(F.col("_of")))
    known = known.groupBy("_of").agg(F.max("_y").alias("_y"))
    known = known.orderBy(F.xxhash64("_of"), "_of").limit(max_rows)
    rows = docs.select(whole_id(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    # At most max_rows pairs of numbers are sent to the tasks.
    rows = rows.join(F.broadcast(known), F.col("_id") == F.col("_of"))
    return rows.groupBy("_text").agg(F.max("_y").alias("_y"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
    least_rows: int = LEAST_ROWS,
    by_chance: float = BY_CHANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    spark = docs.sparkSession
    folder = run_folder(spark, "toxicity")
    training_rows(docs, labels, max_rows, id_col, text_col).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")

    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    if n == 0:
        return Model((), (), -500.0)

    def count(batches: Iterator) -> Iterator:
        every, bad = Counter(), Counter()
        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = features_of(words_of(text))
                every.update(found)
                if y:
                    bad.update(found)
            if len(every) > HELD_FEATURES:
                yield _counted(every, bad)
                every, bad = Counter(), Counter()
        yield _counted(every, bad)

    counts = rows.mapInArrow(count, "feature string, n long, toxic long").groupBy("feature")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where(F.col("n") >= least_rows)
    counts = stored(counts, f"{folder}/counts")
    best = telling(counts, toxic / n, np.log(max(counts.count(), 1) / by_chance), max_features)
    terms = [t for g in groups for t in g]
    chosen = sorted({r["feature"] for r in best.select("feature").collect()} | set(terms))
    at = {f: i for i, f in enumerate(chosen)}

    def active(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            ids, twins = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                twin = swapped(words, groups)
                ids.append(sorted(at[f] for f in features_of(words) if f in at))
                twins.append(None if twin is None else sorted(at[f] for f in features_of(twin) if f in at))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(twins, kind), batch.column(1)], ["ids", "twin", "y"]
            )

    # Sorted, so that a rerun adds up in the same order; max_rows rows of chosen features at most.
    sample = sorted(
        (list(r["ids"]), list(r["twin"] or []), r["twin"] is not None, r["y"])
        for r in rows.mapInArrow(active, "ids array<int>, twin array<int>, y int").collect()
    )
    weights, intercept = _descend(sample, len(chosen))
    return Model(tuple(chosen), tuple(weights.tolist()), intercept)


def telling(counts: DataFrame, share: float, least: float, most: int) -> DataFrame:
    """The features of ``counts`` whose rows are toxic more often than ``share``, with an evidence of ``least`` or more."""
    if not 0 < share < 1:
        return counts.limit(0)
    rate = F.col("toxic") / F.col("n")
    clean = F.col("n") - F.col("toxic")
    evidence = F.col("toxic") * F.log(rate / share)
    evidence += F.when(clean > 0, clean * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    counts = counts.where(rate > share).withColumn("evidence", evidence)
    return counts.where(F.col("evidence") >= float(least)).orderBy(F.desc("evidence"), "feature").limit(most)


def _counted(every: Counter, bad: Counter):
    import pyarrow as pa

    names = list(every)
    columns = [names, [every[f] for f in names], [bad[f] for f in names]]
    kinds = [pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["feature", "n", "toxic"]
    )


def _matrix(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return row, np.array([i for x in lists for i in x], np.int64)


def _descend(sample: list[tuple], size: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by full gradients with Adam's steps: log loss, ridge, and the twins' differences."""
    y = np.array([s[3] for s in sample], float)
    row, column = _matrix([s[0] for s in sample])
    paired = [s for s in sample if s[2]]
    one, twin = _matrix([s[0] for s in paired]), _matrix([s[1] for s in paired])
    w, count = np.zeros(size + 1), len(sample)
    w[-1] = np.log((y.sum() + 0.5) / (count - y.sum() + 0.5))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[column], count) + w[-1]
        off = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        gradient = np.append(np.bincount(column, off[row], size) / count, off.mean())
        if paired:
            gap = np.bincount(one[0], w[one[1]], len(paired)) - np.bincount(twin[0], w[twin[1]], len(paired))
            pull = np.bincount(one[1], gap[one[0]], size) - np.bincount(twin[1], gap[twin[0]], size)
            gradient[:-1] += 2 * PAIRING * pull / count
        gradient[:-1] += RIDGE * w[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        w -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = model.scorer()
        for batch in slices(batches):
            found = [score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["doc_id", "held_out", "score"]
            )

    key = whole_id(id_col)
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), whole_text(text_col).alias("_text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all of their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = model.scorer()
        for batch in slices(batches):
            clean = [score(t or "") < 0.5 for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
