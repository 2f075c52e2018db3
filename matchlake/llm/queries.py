"""Registered queries of the text operators, over whole tables.

Exact dedup, line dedup and the divergence audit have an SQL form
(``ORACLES``); the others are tested against brute force, exact round trips or
held-out labels in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    class_lm,
    divergence,
    exact_dedup,
    fingerprints,
    jaccard_join,
    langid,
    licenses,
    line_dedup,
    mixing,
    pieces,
    quality,
    toxicity,
)
from .common import documents, labels


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(documents(spark, sf_dir))


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(documents(spark, sf_dir))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), labels(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir)).select("doc_id", "copy_id", "class_id", "n_links")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(documents(spark, sf_dir))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_class_lm, op3_licenses, op4_toxicity, op5_exact_dedup, op6_jaccard_join, op7_langid,
        op8_sentencepiece, op9_mixing, op10_quality, op11_line_dedup, op12_alignment, op13_divergence,
    )
}

ORACLES = {
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
        FROM d
    """,
    "op11_line_dedup": line_dedup.ORACLE,
    "op13_divergence": divergence.ORACLE,
}
