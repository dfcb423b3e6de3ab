"""A corpus from raw documents to training sequences, in five stages.

Each stage works on all that the one before it kept; its result is written as
Parquet to the shared folder and read again, so a lost executor costs no more than
the stage it was in. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tablesync.llm.common import table
from tablesync.session import run_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, calls toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words, stays."""
    return near_dedup.keep_one(docs, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixing.curriculum(docs)


def in_written_order(docs: DataFrame) -> DataFrame:
    """The rows of a scan in the order in which a sorted frame was written; any other frame is left as it is.

    A scan orders files by size and packs several into a partition. The writing task's number and the
    number of its file are in the file's name.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.children().isEmpty() or plan.metadataOutput().isEmpty():
        return docs
    place = docs.metadataColumn("_metadata")
    name = place["file_name"]
    task, file = (F.regexp_extract(name, at, 1).try_cast("long") for at in (r"^part-(\d+)", r"-c(\d+)"))
    return docs.orderBy(task, file, name, place["row_index"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences; blocks of sequences follow each other in the order of training."""
    return packing.pack(in_written_order(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A classifier, sketches and token ids are beyond SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents`` in ``sf_dir``."""
    folder = run_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
