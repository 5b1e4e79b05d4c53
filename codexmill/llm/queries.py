"""The subpackage's queries, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codexmill.llm import chat, decontam, fingerprint, jaccard, langid, licences, mixing, quality, substring, toxicity
from codexmill.llm.common import table


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1_mixing(table(spark, sf_dir, "documents"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op2_chat_format(table(spark, sf_dir, "conversations"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op3_language_id(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.op9_licence_scan(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op10_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op4_fingerprints(table(spark, sf_dir, "documents"))


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op5_ngram_jaccard(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.op6_substring_dedup(table(spark, sf_dir, "documents"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op7_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op8_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_mixing": _op1, "op2_chat_format": _op2, "op3_language_id": _op3, "op4_fingerprints": _op4, "near_fingerprints": _near, "op5_ngram_jaccard": _op5, "op6_substring_dedup": _op6, "op7_quality": _op7, "op8_decontamination": _op8, "op9_licence_scan": _op9, "op10_toxicity": _op10}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op8_decontamination": decontam.ORACLE}
