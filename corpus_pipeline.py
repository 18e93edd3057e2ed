"""The corpus pipeline: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetmill.llm import packing, quality, secrets, simhash, toxicity
from sheetmill.llm.common import table
from sheetmill.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor a certified cutoff rejects."""
    return quality.reject_low_quality(docs, table(spark, sf_dir, "labels"))


def toxic_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within 3 bits (3-word shingles)."""
    return simhash.drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported secret replaced by a mark."""
    return secrets.redact_secrets(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_language),
    ("simhash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("packing", sequence_packing),
]

#: SQL has neither the tokenizer nor XXH64: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
