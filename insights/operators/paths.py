"""Ordered paths: which keys take given steps in order, and how fast.

A path is a list of steps; between two steps other events of the key may lie, or none
(``direct``).  The automaton's state is the number of steps taken.  What a stretch of events
does to it is one small matrix: entry (i, j) is the least cost of coming from i to j steps,
where the first step costs minus its time and the last one plus its time, all else nothing.
Matrices of adjacent stretches multiply (least sum), in any grouping, so that a busy key is
cut anywhere: events are dealt over ranges of (key, time, order), each task multiplies the
stretch of every key it meets, and the stretches of a key, one a task at most, multiply last.
Entry (0, last) of the product is the shortest time of a whole path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrices(hits: np.ndarray, at: np.ndarray, steps: int, direct: Sequence[int]) -> np.ndarray:
    """One (steps + 1) x (steps + 1) matrix per event; bit i of ``hits``: the event can be step i (from 0)."""
    m = np.full((len(hits), steps + 1, steps + 1), np.inf)
    for i in range(steps + 1):
        if i not in direct:
            m[:, i, i] = 0.0
    for i in range(steps):
        cost = (at if i == steps - 1 else 0.0) - (at if i == 0 else 0.0)
        m[:, i, i + 1] = np.where(hits >> i & 1 == 1, cost, np.inf)
    return m


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-sum products of two lists of matrices."""
    out = np.full(a.shape, np.inf)
    for x in range(a.shape[1]):
        np.minimum(out, a[:, :, x, None] + b[:, None, x, :], out=out)
    return out


def stretches(m: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The product of each run of equal ``group`` numbers (rising from 0), neighbours first, in halving rounds."""
    while True:
        first = np.searchsorted(group, group)
        even = (np.arange(len(group)) - first) % 2 == 0
        if even.all():
            return m
        left = np.flatnonzero(even[:-1] & (group[1:] == group[:-1]))
        m[left] = product(m[left], m[left + 1])
        m, group = m[even], group[even]


def _walk(steps: int, direct: tuple[int, ...]):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last key of the rows so far: (tag, key, part), its matrix

        def give(keys, m):
            flat = pa.array(list(m.reshape(len(m), -1)), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([*keys, flat], ["tag", "key", "part", "m"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tag = batch.column("tag")
            new = np.ones(batch.num_rows, bool)
            new[1:] = pc.not_equal(tag[1:], tag[:-1]).to_numpy(zero_copy_only=False)
            start = pa.array(np.flatnonzero(new))
            keys = [batch.column(c).take(start) for c in ("tag", "key", "part")]
            events = matrices(batch.column("hits").to_numpy(), batch.column("at").to_numpy().astype(float), steps, direct)
            m = stretches(events, np.cumsum(new) - 1)
            if held is not None:
                if held[0][0][0].equals(keys[0][0]):
                    m[:1] = product(held[1], m[:1])
                else:
                    yield give(*held)
            held = [k[-1:] for k in keys], m[-1:]
            if len(m) > 1:
                yield give([k[:-1] for k in keys], m[:-1])
        if held is not None:
            yield give(*held)
    return walk


def _times(size: int):
    """The same product for arrays inside Spark: the few stretches of a key."""
    def times(a: Column, b: Column) -> Column:
        def cell(c):
            row, col = F.floor(c / size) * size, c % size
            ways = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda x: F.get(a, (row + x).cast("int"))
                               + F.get(b, (x * size + col).cast("int")))
            return F.array_min(ways)
        return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), cell)
    return times


def ordered_paths(events: DataFrame, key: str, at: Column, order: Sequence[str], steps: Sequence[Column],
                  direct: Sequence[int] = ()) -> DataFrame:
    """(key, reached, span) for every key with an event that can be a step.

    ``at``: a whole number (day, second), less than 2^53 in size; ``order``: columns that tell apart events of the
    same ``at`` (events equal in these too come in any order); ``steps``: a condition per step (null: no);
    ``direct``: numbers i of steps (from 1) whose next step must be the key's very next event.  One event is one step.
    ``span``: least ``at`` of the last step minus ``at`` of the first, over all whole paths; null if there is none.
    ``reached``: the most steps that the key has behind it at its end, the last step counting for good (without
    ``direct`` simply the most steps taken in order).  A null key is a key; events of null ``at`` are left out."""
    k, size = len(steps), len(steps) + 1
    if any(not 1 <= i < k for i in direct):
        raise ValueError("direct: numbers of steps that have a next step")
    hits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(steps)), F.lit(0))
    tag = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    asked = events.select(tag.alias("tag"), F.col(key).alias("key"), at.cast("long").alias("at"), hits.cast("long").alias("hits"),
                          *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).filter(F.col("at").isNotNull())
    if not direct:
        asked = asked.filter(F.col("hits") != 0)
    place = ["tag", "at", *[f"o{i}" for i in range(len(order))]]
    ranges = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (asked.repartitionByRange(ranges, *place).sortWithinPartitions(*place)
             .select("tag", "key", F.spark_partition_id().alias("part"), "at", "hits"))
    schema = dealt.select("tag", "key", "part", F.lit(None).cast("array<double>").alias("m")).schema
    cut = dealt.mapInArrow(_walk(k, tuple(direct)), schema)
    pieces = cut.groupBy("tag").agg(F.first("key").alias("key"),
                                    F.array_sort(F.collect_list(F.struct("part", "m"))).alias("p"))
    whole = F.aggregate(F.slice("p", 2, F.size("p")), F.get(F.col("p"), F.lit(0))["m"], lambda a, b: _times(size)(a, b["m"]))
    inf = F.lit(float("inf"))
    row = [F.get("m", F.lit(j)) for j in range(size)]
    reached = F.coalesce(*[F.when(row[j] < inf, F.lit(j)) for j in range(k, 0, -1)], F.lit(0))
    out = pieces.select("key", whole.alias("m")).select(
        F.col("key").alias(key), reached.alias("reached"), F.when(row[k] < inf, row[k].cast("long")).alias("span"))
    return out
