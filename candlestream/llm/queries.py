"""Registered queries of the operators of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.llm import (
    decontamination, hard_negatives, host_trust, jaccard_join, language_id, lm_scoring, packing, pii,
    quality, suffix_dedup, token_counts, warc, whitening,
)
from candlestream.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces).withColumnRenamed("doc", "doc_id")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.cascade(docs, with_facts=True).select(
        "doc_id", *quality.FACTS, "base_failed", F.isnull("failed_rule").alias("kept")
    )


def op9_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return host_trust.judge(pages).select(
        "page_id", "host", "path", "rule", "verdict", "trust", "distrust"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"))
    mislabelled = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", mislabelled), F.col("id") % 100 == 0)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.counts(docs, public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_benchmark_leaks": op5_benchmark_leaks,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_warc_shards": op7_warc_shards,
    "op8_quality_cascade": op8_quality_cascade,
    "op9_host_trust": op9_host_trust,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_counts": op12_token_counts,
    "op13_whitening": op13_whitening,
}
