"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendscope.llm import (decontaminate, embedding_dedup, embedding_whitening, exact_dedup, language_id, license_scan,
                           lm_score, merkle_manifest, minhash_dedup, mixing, packing, toxicity, url_filter)
from lendscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_language(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tamper_report(table(spark, sf_dir, "documents"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Query]:
    found = [op1_lm_score, op2_license_scan, op3_minhash_dedup, op4_embedding_dedup, op5_url_filter, op6_exact_dedup,
             op7_language_id, op8_mixing, op9_packing, op10_toxicity, op11_embedding_whitening, op12_merkle_manifest,
             op13_decontaminate]
    return {q.__name__: q for q in found}


def llm_oracle_sql() -> dict[str, str]:
    from lendscope.llm import oracle
    return oracle.sql()
