"""Line dedup: lines that many documents share stay in one of them.

Lines are exploded and normalised, hashed to 128 bits, and the documents of each
hash are counted; lines of hashes at or over the threshold go, except in the
largest id that holds them, and the rest is put together by position. The
count is taken over distinct (hash, document) pairs, reduced in every map task;
a line that a third of all documents hold is one row per task there, and the join
that marks its copies is one whose large partitions Spark splits.

Defined cases: a null or empty text is one empty line; a null id counts as one document and holds
a line only if no other id does; rows that repeat an id count as one document,
and each keeps its own text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import LOWER, UPPER, WHITE, dealt_anew, whole_id, whole_text


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(WHITE)), UPPER, LOWER)


def hashes(key: Column) -> list[Column]:
    """128 bits: two hashes with seeds of their own."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key).alias("_h2")]


def drop_shared_lines(
    docs: DataFrame, min_docs: int = 3, min_length: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``doc_id``, ``n_lines``, ``n_dropped`` and the ``kept_text``."""
    rows = docs.select(whole_id(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    # An id with two texts is two rows: the text's hash tells them apart.
    rows = rows.select("_id", F.xxhash64("_text").alias("_of"), F.split("_text", "\n", -1).alias("_lines"))
    lines = rows.select("_id", "_of", F.posexplode("_lines").alias("_at", "_line"))
    lines = lines.select("_id", "_of", "_at", line_key(F.col("_line")).alias("_key"))
    lines = lines.where(F.length("_key") >= min_length).select("_id", "_of", "_at", *hashes(F.col("_key")))

    holders = lines.select("_h1", "_h2", "_id").distinct()
    shared = holders.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper"))
    shared = shared.where(F.col("_docs") >= min_docs)

    gone = lines.join(dealt_anew(shared, "_h1", "_h2"), ["_h1", "_h2"]).where(~F.col("_id").eqNullSafe(F.col("_keeper")))
    gone = gone.groupBy(F.col("_id").alias("_gone_id"), F.col("_of").alias("_gone_of")).agg(
        F.sort_array(F.collect_set("_at")).alias("_gone")
    )
    same = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_of") == F.col("_gone_of"))
    both = rows.join(gone, same, "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    # What lies between one dropped line and the next is one slice.
    both = both.withColumn("_cuts", F.concat(F.array(F.lit(-1)), "_gone", F.array(F.size("_lines"))))
    between = F.transform(
        F.sequence(F.lit(1), F.size("_cuts") - 1),
        lambda i: F.slice(
            "_lines",
            F.get("_cuts", i - 1) + 2,
            F.get("_cuts", i) - F.get("_cuts", i - 1) - 1,
        ),
    )
    return both.select(
        F.col("_id").alias("doc_id"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_dropped"),
        F.array_join(F.flatten(between), "\n").alias("kept_text"),
    )
