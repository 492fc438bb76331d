"""Parquet table loader.

Tables are read lazily, once per ``Tables`` object: a DataFrame is only a
plan, so asking for a table twice does not read it twice, and Catalyst prunes
the columns and pushes the filters of every query into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The table names of the driver's data set.
TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """``Tables(spark, "/data/sf1").orders`` → DataFrame over ``orders.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
