"""The corpus pipeline: documents to packed training sequences.

Language identification (rejected documents go), exact deduplication (the row with the
largest doc_id of equal texts stays), n-gram Jaccard join (one document of each class
stays), mixing of sources (each document as often as the mix takes it), packing.
Every stage works on all rows that its predecessor kept; stages hand over Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from insights.llm import exact_dedup, language, mixing, near_duplicates, packing
from insights.plans.sinks import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: compression, MinHash pruning, hash draws and tokenizers can't be written in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
