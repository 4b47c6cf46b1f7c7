"""A training-data pipeline of five stages; each works on all that its predecessor kept.

Language ID drops documents that it rejects, toxicity those it predicts toxic; of each group of near copies one document
stays; secrets are masked in the text; the last stage packs what is left and returns its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import common, language_id, near_copies, packing, secret_scan, toxicity


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.importable(spark)
    return language_id.kept(docs, language_id.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.importable(spark)
    return toxicity.kept(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.importable(spark)
    return near_copies.kept(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.importable(spark)
    return secret_scan.mask(docs, secret_scan.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The stages' models and tokenizer cannot be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
