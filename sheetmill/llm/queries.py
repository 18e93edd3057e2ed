"""Registered queries of this subpackage: each applies one operator with production parameters
to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheetmill.llm import bpe, chat, codes, licenses, negatives, packing, passages, pii, quality, secrets, simhash, topk, toxicity
from sheetmill.llm.common import table
from sheetmill.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compression_report(table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine_hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_chat_formatting, op2_quality_rules, op3_license_scans, op4_packing, op5_pii, op6_secret_scans, op7_byte_bpe, op8_toxicity, op9_simhash, op10_exact_topk, op11_vector_codes, op12_quality_classifier, op13_hard_negatives)}

__all__ = ["ORACLES", "QUERIES"]
