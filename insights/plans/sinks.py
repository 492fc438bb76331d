"""Sinks: the ``CREATE TABLE … AS`` / temp-table steps of the case studies.

* ``write_table`` — a deliverable table (drop-and-replace = overwrite),
  optionally partitioned (e.g. report month) so later reads prune files.
* ``materialize`` — an intermediate reused by several queries: written once
  as Parquet under the cluster's shared ``spark.checkpoint.dir`` and read
  back, which cuts the lineage (a lost executor re-reads files instead of
  recomputing the whole chain).  Never a machine-local folder on a cluster,
  never ``localCheckpoint``.
* ``release`` — delete what ``materialize`` wrote; also done when Python exits.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names (``spark.checkpoint.dir``).

    Where it is unset, a local session (one machine, as in tests) gets a folder
    of its own; a cluster must name one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="insights-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def release(spark: SparkSession) -> None:
    """Delete the folders ``materialize`` wrote in this session; frames over them end with it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for item in [x for x in _written if x[0] is spark]:
        path = jvm.org.apache.hadoop.fs.Path(item[1])
        path.getFileSystem(conf).delete(path, True)
        _written.remove(item)


@atexit.register
def _release_all() -> None:
    for spark in {id(s): s for s, _ in _written}.values():
        if spark.sparkContext._jsc is not None:
            release(spark)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace a catalog table (``DROP TABLE IF EXISTS`` + ``CREATE TABLE AS``)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder, deleted by ``release``."""
    path = f"{checkpoint_root(spark)}/insights/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Compute ``df`` once, as Parquet in the shared checkpoint folder, and return a
    DataFrame over those files (lineage cut: a lost executor re-reads them)."""
    spark = df.sparkSession
    path = scratch(spark, name or "tmp")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, partition_by: Sequence[str] | None = None) -> None:
    """Write several named outputs (e.g. the monthly report) under one folder."""
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}", partition_by)
