"""Best-fit packing of documents into sequences of bounded length.

Tasks encode whole texts; a document of more than ``capacity`` tokens is cut into
full pieces and a rest.  The histogram of piece lengths (at most ``capacity`` rows)
goes to the driver, which solves the configuration program on it (see
``configurations``).  Its answer is a list of slots: for each length, ranges of
ranks and the configuration that takes them.  Every piece has a rank among the
pieces of its length, worked out in salted buckets, so that neither a hot length nor
a hot document gathers in one task; its slot, hence sequence and offset, follows by
a search in the slot table, which has as many rows as the program's answer has
lengths.  No piece is moved to find its place.

Defined cases: null text is empty (the end id alone); rows that repeat are packed
one by one; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insights.llm import tokens
from insights.llm.configurations import Group, solve
from insights.plans.sinks import materialize

CAPACITY = 2048
END = 0
#: buckets that the pieces of a length are numbered in, at least; more where a bucket would hold more rows
BUCKETS, BUCKET_ROWS = 64, 100_000


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and ``row``, a number of its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, wide = tokens.encoder(tokens.WORD_BPE), capacity * tokens.ID.itemsize
        for b in batches:
            of, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for lo, hi in tokens.slices(texts):
                rows = [(i, k // wide, k // tokens.ID.itemsize, x[k : k + wide])
                        for i, x in zip(of[lo:hi], enc.encode(texts[lo:hi], END), strict=True)
                        for k in range(0, len(x), wide)]
                yield pa.record_batch([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(r[3]) // tokens.ID.itemsize for r in rows], pa.int64()),
                    pa.array([zlib.crc32(np.frombuffer(r[3], tokens.ID).astype("<u4").tobytes()) for r in rows],
                             pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return own.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long").withColumn(
        "row", F.monotonically_increasing_id())


def slot_table(groups: list[Group]) -> dict[str, np.ndarray]:
    """For each length, its ranks in order: from ``rank`` on, configuration ``base`` repeated
    ``multiples`` times takes them, the first of them at ``offset``."""
    rows, base, used = [], 0, {}
    for config, m in groups:
        offset = 0
        for n, a in sorted(config.items(), reverse=True):
            rows.append((n, used.get(n, 0), m, base, offset))
            used[n] = used.get(n, 0) + a * m
            offset += n * a
        base += m
    rows.sort()
    names = ("length", "rank", "multiples", "base", "offset")
    return dict(zip(names, np.array(rows, dtype=np.int64).reshape(-1, 5).T, strict=True))


def ranked(of: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of equal length."""
    salted = of.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    counts = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        F.col("length").alias("_length"), F.col("bucket").alias("_bucket"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return (salted.withColumn("inside", inside)
            .join(before, (F.col("length") == F.col("_length")) & (F.col("bucket") == F.col("_bucket")))
            .withColumn("rank", F.col("before") + F.col("inside")))


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = materialize(pieces(docs, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # capacity rows at most
    slots = slot_table(solve(histogram, capacity))
    buckets = max(BUCKETS, -(-max(histogram.values(), default=0) // BUCKET_ROWS))
    table = docs.sparkSession.sparkContext.broadcast(slots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = table.value
        first = np.searchsorted(s["length"], np.arange(capacity + 2))
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                of, lo, hi = length == n, first[n], first[n + 1]
                at[of] = lo + np.searchsorted(s["rank"][lo:hi], rank[of], side="right") - 1
            nth = rank - s["rank"][at]
            m = s["multiples"][at]
            yield pa.record_batch(
                [*(b.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(s["base"][at] + nth % m), pa.array(s["offset"][at] + nth // m * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(cut, buckets).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
