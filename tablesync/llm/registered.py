"""The operators as registered queries on the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import (
    exact_dedup,
    kd_search,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    secrets,
    spelling,
    suffix_dedup,
    swap_packing,
    token_counts,
    toxicity,
)
from tablesync.llm.common import table
from tablesync.llm.oracle import ORACLE
from tablesync.session import run_folder


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_totals(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op3_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = run_folder(spark, "secret-ledger")
    found = secrets.scan_versions(table(spark, sf_dir, "documents"), ["doc_id"], ledger)
    kinds = [r.kind for r in secrets.RULES]
    spans = secrets.listed(kinds)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.exact_top_k(table(spark, sf_dir, "embeddings"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=2)


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs.select("doc_id", "text", "source"))
    mixed = mixed.select(
        F.col("c0").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
        F.col("_first").alias("first_time"),
    )
    return mixed.orderBy(F.col("first_time").asc_nulls_last(), "doc_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_token_counts,
        op3_tier_packing,
        op4_exact_dedup,
        op5_secret_scan,
        op6_toxicity,
        op7_line_dedup,
        op8_kd_search,
        op9_near_dedup,
        op10_curriculum_mix,
        op11_prefix_trie,
        op12_spelling_variants,
        op13_swap_packing,
    )
}

__all__ = ["ORACLE", "QUERIES"]
