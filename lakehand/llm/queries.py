"""The registered queries ``opN_<name>`` over whole tables, and their SQL where one states them."""

from __future__ import annotations

import uuid

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from lakehand.llm import (alignment, filter_audit, fingerprints, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, secret_scan,
                          substring_dedup, token_binary, warc)
from lakehand.llm.common import documents
from lakehand.llm.oracles import NO_SQL, ORACLE  # noqa: F401 - read by __spark_entry__ and the tests
from lakehand.session import shared_dir


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/lakehand-tokens-{uuid.uuid4().hex}"
    token_binary.write_tokens(documents(spark, sf_dir), folder)
    return token_binary.read_tokens(spark, folder)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring_dedup.dedup(documents(spark, sf_dir))
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selection(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/lakehand-warc-{uuid.uuid4().hex}"
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.page_records(warc.read_archives(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_binary": op2_token_binary,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_fingerprints": op5_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_packing": op7_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_mixing": op9_mixing,
    "op10_near_dedup": op10_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_warc": op12_warc,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}
