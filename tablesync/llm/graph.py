"""Connected components of an edge table, with tables in the shared folder between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import dealt_anew


def stored(frame: DataFrame, path: str) -> DataFrame:
    """The frame written to the shared folder and read again: it survives lost executors and cuts the lineage."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    Rounds of large star and small star: each node links its larger neighbours, then its smaller
    ones, to the smallest of them, until every component is a star around its smallest node. The smallest neighbour is an
    aggregate reduced in every map task, and the joins on a node with many neighbours are ones
    that Spark splits.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links, turn = stored(links, f"{folder}/links-0"), 0
    while not _are_stars(links):
        turn += 1
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(dealt_anew(least, "u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(dealt_anew(least, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        links = stored(small.where("u <> v").distinct(), f"{folder}/links-{turn}")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or is one, not both."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return not ends.where("up > 1 OR (up > 0 AND down > 0)").head(1)
