"""The registered queries of this subpackage: one thin query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from insights.llm import (exact_dedup, fingerprints, language, licenses, mixing, near_duplicates, packing, periodic, pii, quality,
                          token_files, vector_links, whitening)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": lambda spark, d: pii.report(documents(spark, d)),
    "op2_quality": lambda spark, d: quality.classify(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
    "op3_licenses": lambda spark, d: licenses.scan(documents(spark, d)),
    "op4_language": lambda spark, d: language.predict(documents(spark, d)),
    "op5_mixing": lambda spark, d: mixing.mix(documents(spark, d)),
    "op6_packing": lambda spark, d: packing.pack(documents(spark, d)),
    "op7_token_files": lambda spark, d: token_files.round_trip(documents(spark, d)),
    "op8_exact_dedup": lambda spark, d: exact_dedup.exact_dedup(documents(spark, d)),
    "op9_fingerprints": lambda spark, d: fingerprints.fingerprint(documents(spark, d)),
    "op10_near_duplicates": lambda spark, d: near_duplicates.classes(documents(spark, d)),
    "op11_whitening": lambda spark, d: whitening.whiten(embeddings(spark, d)),
    "op12_periodic_runs": lambda spark, d: periodic.report(documents(spark, d)),
    "op13_vector_links": lambda spark, d: vector_links.near_copies(embeddings(spark, d)),
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": exact_dedup.SQL,
}
