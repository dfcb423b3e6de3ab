"""What the operators share: the white space of the contracts, whole texts, reading a table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every contract: the blank and tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def whole_id(name: str = "doc_id") -> Column:
    return F.col(f"`{name}`").cast("long")


def slices(batches: Iterator, most: int = 4 << 20) -> Iterator:
    """Arrow batches in slices of about ``most`` bytes, so that a task holds few of its rows as Python objects."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step)


def dealt_anew(frame: DataFrame, *keys: str) -> DataFrame:
    """The same rows, for a join on ``keys`` by which they were just grouped.

    Without it Spark joins where it grouped, with no exchange on this side, and then cannot split a partition that a
    hot key fills on the other side. Keys are long, text or binary.
    """
    kinds = dict(frame.dtypes)
    again = {k: F.col(k).bitwiseXOR(F.lit(0)) if kinds[k] == "bigint" else F.substring(k, 1, 2**31 - 1) for k in keys}
    return frame.withColumns(again)
