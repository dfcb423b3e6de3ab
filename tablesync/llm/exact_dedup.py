"""Exact dedup: group by a 128-bit content hash, compare the bytes in a group, keep one row.

Texts are equal when they are identical without white space. The grouping key is
the hash *and* the normalised text itself, so two texts with the same hash never
share a group: Spark compares the hash first and the bytes only where hashes
agree. The grouping is reduced in every map task, so a text that makes up a third
of all rows sends one row per task.

Defined cases: a null text is empty; a null id is larger than every other; an
empty table gives an empty result; rows that repeat an id with the same text
are the same document, and ``keep_one`` leaves one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import WHITE_CLASS, whole_id, whole_text


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_CLASS, "")


def _rank(text: Column, key: Column) -> list[Column]:
    """Greatest for the row that stays: most code points, then the smallest id, nulls last."""
    return [F.length(text).alias("_n"), key.isNotNull().alias("_has"), F.bitwise_not(key).alias("_not_id")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, the id that stays, the group's size, whether it stays, and the normalised text's SHA-256."""
    rows = docs.select(whole_id(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    rows = rows.select("_id", "_text", normalised(F.col("_text")).alias("_norm"))
    rows = rows.withColumn("_hash", F.unhex(F.md5("_norm")))
    groups = rows.groupBy("_hash", "_norm").agg(
        F.max(F.struct(*_rank(F.col("_text"), F.col("_id")))).alias("_best"), F.count(F.lit(1)).alias("group_size")
    )
    groups = groups.select(
        F.col("_hash").alias("_of"),
        F.sha2("_norm", 256).alias("_sha_of"),
        F.bitwise_not(F.col("_best._not_id")).alias("keep_id"),
        "group_size",
    )
    # The second digest tells apart the groups of a hash that differ in their bytes.
    members = rows.select("_id", "_hash", F.sha2("_norm", 256).alias("text_sha256"))
    same = (F.col("_hash") == F.col("_of")) & (F.col("text_sha256") == F.col("_sha_of"))
    return members.join(groups, same).select(
        F.col("_id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of every group that stays, with all of its columns."""
    text = whole_text(text_col)
    norm = normalised(text)
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row")
    # A row's other columns decide between rows that repeat an id, so that a rerun agrees.
    other = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)])).alias("_other")
    rank = F.struct(*_rank(text, whole_id(id_col)), text.alias("_whole"), other)
    rows = docs.select(F.unhex(F.md5(norm)).alias("_hash"), norm.alias("_norm"), rank.alias("_rank"), whole)
    best = rows.groupBy("_hash", "_norm").agg(F.max_by("_row", "_rank").alias("_row"))
    return best.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
