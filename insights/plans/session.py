"""Session settings sized to the data.

``recommended_conf(input_bytes)`` returns the Spark settings the operators
are designed for: AQE with skew-join splitting and partition coalescing,
shuffle partitions sized so each holds about ``target_partition_mb`` of
shuffle data, and scan splits of ``max_partition_mb``.  Apply them with
``SparkSession.builder.config(map=...)`` or ``spark.conf.set``.
"""

from __future__ import annotations

import math


def input_bytes(spark, paths: list[str]) -> int:
    """Total size of the given files/folders, read through Hadoop's FileSystem API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def recommended_conf(input_bytes: int, target_partition_mb: int = 256, max_partition_mb: int = 256,
                     min_partitions: int = 8) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` of Parquet.

    Shuffle partitions ≈ input / target size (Parquet expands in memory, and
    the operators aggregate before shuffling, so input size is a safe upper
    bound for shuffle size); AQE coalesces the small ones at run time and
    splits skewed join partitions.
    """
    parts = max(min_partitions, math.ceil(input_bytes / (target_partition_mb << 20)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{max_partition_mb}m",
    }
