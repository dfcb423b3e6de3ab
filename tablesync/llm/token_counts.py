"""Token counts from an exact histogram of encoded lengths.

Every task encodes its documents and returns one row for each length it met, so
what is shuffled grows with the number of different lengths and tasks, not with the
documents. Suffix sums over the histogram answer the questions of every
context limit: documents and tokens at or over it, what truncation to it would
leave, and the share of documents up to it. They are taken in bands of lengths, the
bands' sums first, so no task sorts the whole histogram.

Defined cases: a null or empty text has no tokens; ids play no part, so repeated rows
count each; an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import slices, whole_text
from tablesync.llm.tokens import chunks, tokenizer, tokenizer_path

BAND = 1024


def length_histogram(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``n_tokens`` and the number of ``documents`` encoded to that many."""
    path = path or tokenizer_path()

    def lengths(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode, seen = tokenizer(path), np.zeros(1, np.int64)
        for batch in slices(batches):
            texts = batch.column(0).to_pylist()
            for part in chunks(texts):
                found = np.bincount(encode.counts(texts[part]))
                if len(found) > len(seen):
                    seen = np.concatenate([seen, np.zeros(len(found) - len(seen), np.int64)])
                seen[: len(found)] += found
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(seen[met], pa.int64())], ["n", "d"])

    found = docs.select(whole_text(text_col).alias("_text")).mapInArrow(lengths, "n long, d long")
    return found.groupBy(F.col("n").alias("n_tokens")).agg(F.sum("d").alias("documents"))


def length_totals(histogram: DataFrame) -> DataFrame:
    """For every length as a context limit: what lies at or over it, and what truncation to it leaves.

    ``docs_at_least`` and ``tokens_at_least``; ``truncated_tokens``, the tokens left when every document is
    cut to that length; ``share_at_most``, the share of documents that fit, from which quantiles follow.
    """
    rows = histogram.withColumn("_band", F.floor(F.col("n_tokens") / BAND))
    rows = rows.withColumn("_tokens", F.col("n_tokens") * F.col("documents"))
    bands = rows.groupBy("_band").agg(F.sum("documents").alias("_docs"), F.sum("_tokens").alias("_toks"))
    above = Window.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    bands = bands.select(
        "_band",
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_toks").over(above), F.lit(0)).alias("_toks_above"),
        F.sum("_docs").over(every).alias("_all_docs"),
        F.sum("_toks").over(every).alias("_all_toks"),
    )
    within = Window.partitionBy("_band").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(bands, "_band").select(
        "n_tokens",
        "documents",
        (F.sum("documents").over(within) + F.col("_docs_above")).alias("docs_at_least"),
        (F.sum("_tokens").over(within) + F.col("_toks_above")).alias("tokens_at_least"),
        "_all_docs",
        "_all_toks",
    )
    shorter = F.col("_all_toks") - F.col("tokens_at_least")
    return rows.select(
        "n_tokens",
        "documents",
        "docs_at_least",
        "tokens_at_least",
        (shorter + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("_all_docs") - F.col("docs_at_least") + F.col("documents")) / F.col("_all_docs")).alias("share_at_most"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """One row for each context limit, also for limits that no document has as its length."""
    rows = histogram.withColumn("context", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    cut = F.least("n_tokens", "context") * F.col("documents")
    over = F.when(F.col("n_tokens") > F.col("context"), F.col("documents")).otherwise(0)
    return rows.groupBy("context").agg(
        F.sum("documents").alias("documents"), F.sum(over).alias("docs_over"), F.sum(cut).alias("truncated_tokens")
    )


def quantiles(totals: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that the given shares of documents don't exceed, from ``length_totals``."""
    rows = totals.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    return rows.where(F.col("share_at_most") >= F.col("share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
