"""The operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, license_scan, merkle, ngram_join, packing, quality_rules, secret_scan, sharding, token_counts, toxicity, url_filter, whitening
from .common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digest(table(spark, sf_dir, "conversations"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.page_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.document_licenses(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_quality_rules, op3_url_filter, op4_toxicity, op5_decontaminate,
        op6_token_counts, op7_license_scan, op8_packing, op9_sharding, op10_ngram_join,
        op11_secret_scan, op12_merkle_manifest, op13_whitening,
    )
}

ORACLES = {
    "op1_chat_format": chat_format.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_url_filter": url_filter.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_license_scan": license_scan.ORACLE,
    "op10_ngram_join": ngram_join.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
