"""Registered queries of the text operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealens.llm import ann, decontam, licences, oracles, packing, pages, pii, ppm, prefix_trie, quality, resampling, secret_scan, simhash, substring
from arealens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_pu_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op7_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query
def op3_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read_table(spark, sf_dir, "documents"))


@query
def op6_robust_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op8_line_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.extract(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op9_dice_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    counts = [secret_scan.count_of(F.col("base"), k.name).alias(f"n_{k.name}") for k in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.written(F.col("spans")).alias("spans"))


ORACLES |= {
    "op11_importance_resampling": oracles.IMPORTANCE_RESAMPLING,
    "op12_conversation_prefix_trie": oracles.CONVERSATION_PREFIX_TRIE,
    "op13_secret_scan": oracles.SECRET_SCAN,
}
