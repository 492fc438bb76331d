"""Token-id files: all texts as ids in ascending doc_id order, in patched
frame-of-reference blocks.

The documents are range-partitioned and sorted by doc_id; each task encodes its
texts, appends the end id to each, and writes segments: a segment holds whole
documents (``SEGMENT`` ids or the one document that is longer), its block file and
the index of its documents.  Spark's writer commits them as Parquet rows, so lost
executors, retried tasks and remote stores are its business; a segment's place is
(part, segment).  Reading goes by the index alone and decodes whole segments.

Defined cases: null text is empty (the end id alone); a null doc_id comes first;
rows that repeat a doc_id follow each other in text order; an empty table gives no
segment and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from insights.llm import pfor, tokens
from insights.plans.sinks import checkpoint_root, materialize

END = 2
SEGMENT = 1 << 18
SCHEMA = "part int, segment int, n_docs int, n_tokens long, doc_ids array<long>, lengths array<long>, data binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, segment = TaskContext.get().partitionId(), 0
    enc = tokens.encoder(tokens.BYTE_BPE)
    doc_ids: list[int | None] = []
    ids: list[bytes] = []
    held = 0

    def closed() -> pa.RecordBatch:
        lengths = [len(x) // tokens.ID.itemsize for x in ids]
        data = pfor.encode(np.frombuffer(b"".join(ids), tokens.ID))
        return pa.record_batch([
            pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int32()),
            pa.array([sum(lengths)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())), pa.array([data], pa.binary())],
            names=["part", "segment", "n_docs", "n_tokens", "doc_ids", "lengths", "data"])

    for b in batches:
        of, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
        for lo, hi in tokens.slices(texts):
            for i, x in zip(of[lo:hi], enc.encode(texts[lo:hi], END), strict=True):
                doc_ids.append(i)
                ids.append(x)
                held += len(x)
                if held >= SEGMENT * tokens.ID.itemsize:
                    yield closed()
                    segment, held, doc_ids, ids = segment + 1, 0, [], []
    if ids:
        yield closed()


def write(docs: DataFrame, path: str) -> None:
    """Encode every whole text and write the segments below ``path``."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    (own.repartitionByRange(F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(_segments, SCHEMA).write.parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files below ``path``."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    # as many rows as files and segments; the running sum inside a file, then over the files
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = rows.select("part", "segment", (F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")).alias("inside"))
    # written, so that Spark knows how small the index is and need not shuffle the data to join it
    starts = materialize(inside.join(before, "part").select(
        "part", "segment", (F.col("before") + F.col("inside")).alias("start")), "token-index")
    return (rows.select("part", "segment", "doc_ids", "lengths", "data").join(starts, ["part", "segment"])
            .select("start", "doc_ids", "lengths", "data")
            .mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, doc_ids, lengths, data in zip(*(b.column(k) for k in ("start", "doc_ids", "lengths", "data")),
                                                 strict=True):
            ids = pfor.decode(data.as_py()).astype("<u4").tobytes()
            n = lengths.values.to_numpy() if hasattr(lengths, "values") else np.array(lengths.as_py())
            end = np.cumsum(n)
            crc = [zlib.crc32(ids[4 * (e - k): 4 * e]) for e, k in zip(end.tolist(), n.tolist(), strict=True)]
            yield pa.record_batch([
                pa.array(doc_ids.as_py(), pa.int64()), pa.array(start.as_py() + end - n, pa.int64()),
                pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame) -> DataFrame:
    """Write to a new folder beside the checkpoints, then read the files back."""
    import uuid

    path = f"{checkpoint_root(docs.sparkSession)}/insights/token-files-{uuid.uuid4().hex}"
    write(docs, path)
    return read(docs.sparkSession, path)
