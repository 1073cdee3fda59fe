"""Registered queries of the text operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.llm import (byte_cnn, decontaminate, html_text, importance, license_scan, merkle, near_dedup, oracle,
                          packing, quality_rules, repeats, secrets, token_count, token_file)

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.fit_licenses(docs))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_file.write_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_file.read_tokens(blocks)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(_read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_read(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=0, size=2048)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = byte_cnn.fit_quality(docs, _read(spark, sf_dir, "labels"))
    return byte_cnn.score(docs, model).select(
        "doc_id", byte_cnn.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance.scored(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))
    return importance.ranked(scored.drop("text")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_read(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return merkle.manifest(
        docs, tampered=[merkle.lowered(docs["text"]) if f == "text" else docs[f] for f in merkle.FIELDS],
        where=F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_licenses, op2_token_file, op3_repeats, op4_decontamination, op5_main_text, op6_packing,
             op7_token_counts, op8_quality, op9_quality_rules, op10_near_dedup, op11_importance, op12_secrets,
             op13_manifest)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLE)
