"""Embedding near-dedup: links of cosine 0.95 and more, found on robust-pruned flat graphs.

1. Equal vectors become one point with a number of copies, so a vector that a third of all
   rows share is one row from here on.
2. A sample of at most ``SAMPLE`` points gives at most ``MOST_CELLS`` centres (k-means; the
   only thing broadcast, of bounded size).  Every point joins the cell of its nearest centre
   and every cell whose border is within a margin: cells overlap.  A border lies between any
   two points in different cells; with a margin of half the link distance each pair would
   share a cell, and the margin is ``SPREAD`` standard deviations of a link's displacement
   across a border in that many dimensions, or that half if it is less.
3. A cell of more than ``BLOCK`` points is dealt into blocks.  Each block gets its graph
   (``flat_graph.build``); the lists that a point has from its cells are put together.
4. Every point is searched for in the graph of every block of its cells, on the joined lists:
   range-expanding greedy search from the medoids.  Pairs of a cell come from pairs of its
   blocks, so no block is beyond a task's memory, and no cell is left out.
5. What is found is checked in double precision, and counts only in the least cell the two
   points share.  A task gives back link counts and a spanning forest, not the pairs; the
   components of the forests are the classes.
6. The audit counts the links of ``AUDIT`` points against all points; below ``RECALL`` the
   search is done again with twice the margin and the beam, up to the margin that loses no cell.

Defined cases: a vector that is null, zero, of another length than the commonest, or holds null or
non-finite components links with nothing; a null vec_id is left out of a component's least id
unless all its ids are null; rows that repeat are copies, each its own vector; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insights.llm import flat_graph
from insights.llm.graph import components
from insights.llm.vectors import dimension, finite, matrix
from insights.plans.sinks import materialize

THRESHOLD = 0.95
CELL, BLOCK, MOST_CELLS, SAMPLE, SAMPLE_BYTES = 2048, 4096, 1024, 16_384, 32 << 20
SPREAD = 1.5
AUDIT, RECALL = 1024, 0.98


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def points_of(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame, int]:
    """(vec_id, h, g of every row; pid, h, g, v, rep_id, copies of every distinct vector that can link; its length).

    h, g: two hashes of the vector, 128 bits, null where it can't link."""
    v = rows[vector].cast("array<double>")
    plain = rows.select(rows[vec_id].cast("long").alias("vec_id"), v.alias("v"))
    can = finite(F.col("v")) & F.exists("v", lambda c: c != 0)
    d = dimension(plain.filter(can), "v")
    own = F.when(can & (F.size("v") == d), F.transform("v", lambda c: c + F.lit(0.0)))  # -0.0 is 0.0
    keyed = (plain.withColumn("v", own).withColumn("h", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
             .withColumn("g", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(13), "v"))))
    points = materialize(keyed.filter(F.col("v").isNotNull()).groupBy("h", "g", "v")
                         .agg(F.min("vec_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
                         .withColumn("pid", F.monotonically_increasing_id()), "points")
    return keyed.select("vec_id", "h", "g"), points, d


def centres(points: DataFrame, n: int, d: int, rounds: int = 10) -> np.ndarray:
    """Up to ``MOST_CELLS`` centres, by k-means on a bounded sample (the points of least hash)."""
    k = max(1, min(MOST_CELLS, math.ceil(n / CELL)))
    sample = points.orderBy("h", "g").limit(max(k, min(SAMPLE, SAMPLE_BYTES // (8 * d)))).select("v").toArrow()
    u = _unit(matrix(sample.column("v").combine_chunks(), d))
    at = u[np.random.Generator(np.random.PCG64(7)).choice(len(u), min(k, len(u)), replace=False)]
    for _ in range(rounds if k > 1 else 1):
        own = (u @ at.T - (at * at).sum(axis=1) / 2).argmax(axis=1)
        total = np.zeros_like(at)
        np.add.at(total, own, u)
        count = np.bincount(own, minlength=len(at))
        at = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], at)
    return np.unique(at, axis=0)


def assigned(points: DataFrame, at: np.ndarray, margin: float) -> DataFrame:
    """pid, copies, u (the unit vector, packed), cells (rising): the cells of every point."""
    d, half = at.shape[1], (at * at).sum(axis=1) / 2
    apart = np.sqrt(np.maximum(2 * (half[:, None] + half[None, :] - at @ at.T), 1e-300))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                b = batch.slice(lo, 2048)
                u = _unit(matrix(b.column("v"), d))
                far = half - u @ at.T  # half the squared distance, but for a constant
                own = far.argmin(axis=1)
                # distance behind the border between the own and another cell
                inside = (far - far[np.arange(len(u)), own][:, None]) / apart[own] <= margin
                inside[np.arange(len(u)), own] = True
                row, cell = np.nonzero(inside)
                offsets = np.searchsorted(row, np.arange(len(u) + 1))
                yield pa.record_batch([b.column("pid"), b.column("copies"), pa.array([x.tobytes() for x in u], pa.binary()),
                                       pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cell, pa.int32()))],
                                      names=["pid", "copies", "u", "cells"])

    return points.select("pid", "copies", "v").mapInArrow(run, "pid long, copies long, u binary, cells array<int>")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """Sorted rows, group by group."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(c).to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            now = tuple(k[lo].tolist())
            if held and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(b.slice(lo, hi - lo))
    if held:
        yield key, pa.Table.from_batches(held)


def _vectors(t: pa.Table, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("u").to_pylist()), dtype=np.float64).reshape(-1, d)


def _built(d: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in _groups(batches, ["cell", "block"]):
            t = t.sort_by("pid")  # the same graph whatever order the rows came in
            near = flat_graph.build(_vectors(t, d).astype(np.float32))
            pid, there = t.column("pid").to_numpy(), near >= 0
            offsets = np.append(0, np.cumsum(there.sum(axis=1)))
            yield pa.record_batch([pa.array(pid), pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(pid[near[there]], pa.int64()))], names=["pid", "near"])

    return run


class _Side:
    """The points of one block, as a task holds them."""

    def __init__(self, t: pa.Table, d: int, cell: int):
        t = t.sort_by("pid")
        self.pid, self.copies = t.column("pid").to_numpy(), t.column("copies").to_numpy()
        self.exact = _vectors(t, d)
        self.points = self.exact.astype(np.float32)
        near = t.column("near").combine_chunks()
        owner = np.repeat(np.arange(len(self.pid)), np.diff(near.offsets.to_numpy()))
        to = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(self.pid, to), len(self.pid) - 1)
        here = self.pid[at] == to  # of the joined lists, the edges inside the block
        self.near = self._padded(owner[here], at[here])
        cells = t.column("cells").combine_chunks()
        owner, value = np.repeat(np.arange(len(self.pid)), np.diff(cells.offsets.to_numpy())), cells.flatten().to_numpy()
        less = value < cell
        self.lower = self._padded(owner[less], value[less])  # cells before this one

    def _padded(self, owner: np.ndarray, value: np.ndarray) -> np.ndarray:
        count = np.bincount(owner, minlength=len(self.pid))
        out = np.full((len(self.pid), max(1, int(count.max(initial=0)))), -1, dtype=np.int64)
        out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)] = value
        return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of the component of each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            return label


def _linked(a: _Side, b: _Side, same: bool, threshold: float, beam: int) -> pa.RecordBatch | None:
    _, q, p = flat_graph.search(a.points, a.near, flat_graph.starts(a.points, a.near), b.points, threshold, beam)
    if same:
        q, p = np.minimum(q, p), np.maximum(q, p)
        pair = np.unique((q * len(a.pid) + p)[q != p])
        q, p = np.divmod(pair, len(a.pid))
    counts = np.zeros(len(a.pid) + len(b.pid), dtype=np.int64)
    left, right = [], []
    for lo in range(0, len(q), flat_graph.CHUNK):
        i, j = p[lo : lo + flat_graph.CHUNK], q[lo : lo + flat_graph.CHUNK]
        met = np.einsum("ij,ij->i", a.exact[i], b.exact[j]) >= threshold
        i, j = i[met], j[met]
        x, y = a.lower[i], b.lower[j]
        first = np.ones(len(i), dtype=bool)  # no lower cell holds both
        for c in range(x.shape[1]):
            first &= ~((x[:, c, None] == y) & (x[:, c, None] >= 0)).any(axis=1)
        i, j = i[first], j[first]
        np.add.at(counts, i, b.copies[j])
        np.add.at(counts, j + (0 if same else len(a.pid)), a.copies[i])
        left.append(i)
        right.append(j + (0 if same else len(a.pid)))
    if not left:
        return None
    pid = np.concatenate([a.pid, b.pid])
    root = pid[_forest(len(pid), np.concatenate(left), np.concatenate(right))]
    some = counts > 0
    return pa.record_batch([pa.array(pid[some]), pa.array(counts[some]), pa.array(root[some])], names=["pid", "links", "root"])


def _searched(d: int, threshold: float, beam: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cell, i, j), t in _groups(batches, ["cell", "i", "j"]):
            block = t.column("block").to_numpy()
            a = _Side(t.filter(pa.array(block == i)), d, cell)
            b = a if i == j else _Side(t.filter(pa.array(block == j)), d, cell)
            if len(a.pid) and len(b.pid):
                out = _linked(a, b, i == j, threshold, beam)
                if out is not None:
                    yield out

    return run


def links(points: DataFrame, at: np.ndarray, margin: float, beam: int, threshold: float = THRESHOLD) -> DataFrame:
    """(pid, links, root): link counts and a spanning forest, a part from each pair of blocks."""
    d = at.shape[1]
    held = materialize(assigned(points, at, margin), "cells")
    in_cells = held.withColumn("cell", F.explode("cells"))
    sizes = in_cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # at most MOST_CELLS rows
    dealt = (in_cells.join(F.broadcast(sizes), "cell")
             .withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int")))
    near = (dealt.select("cell", "block", "pid", "u").repartition("cell", "block").sortWithinPartitions("cell", "block")
            .mapInArrow(_built(d), "pid long, near array<long>"))
    # a point has at most DEGREE neighbours from each of its cells
    joined = materialize(near.groupBy("pid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "near")
    pairs = (dealt.join(joined, "pid")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "pid", "copies", "u", "cells", "near"))
    return (pairs.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
            .mapInArrow(_searched(d, threshold, beam), "pid long, links long, root long"))


def audit(points: DataFrame, found: DataFrame, d: int, threshold: float = THRESHOLD) -> float:
    """The share of the links of at most ``AUDIT`` points (by hash) that were found; brute force against all points."""
    sample = points.orderBy(F.xxhash64("h", "g"), "pid").limit(AUDIT).select("pid", "v").toArrow()
    pid, u = sample.column("pid").to_numpy(), _unit(matrix(sample.column("v").combine_chunks(), d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pid), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                b = batch.slice(lo, 4096)
                near = u @ _unit(matrix(b.column("v"), d)).T >= threshold
                near &= pid[:, None] != b.column("pid").to_numpy()[None, :]
                total += near @ b.column("copies").to_numpy()
        yield pa.record_batch([pa.array(pid), pa.array(total)], names=["pid", "exact"])

    exact = points.select("pid", "copies", "v").mapInArrow(run, "pid long, exact long").groupBy("pid").agg(F.sum("exact").alias("exact"))
    mine = found.groupBy("pid").agg(F.sum("links").alias("links"))
    r = exact.join(mine, "pid", "left").agg(F.sum("exact").alias("e"), F.sum(F.least("exact", F.coalesce("links", F.lit(0)))).alias("f")).first()
    return r["f"] / r["e"] if r["e"] else 1.0


def near_copies(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, and the recall of the audit, for every row."""
    keys, points, d = points_of(rows, vec_id, vector)
    n = points.count()
    if not n:
        return keys.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"), F.lit(1.0).alias("recall"))
    at, half = centres(points, n, d), math.sqrt(2 - 2 * threshold) / 2
    margin, beam = min(half, SPREAD * 2 * half / math.sqrt(d)), flat_graph.BEAM
    while True:
        found = materialize(links(points, at, margin, beam, threshold), "links")
        recall = audit(points, found, d, threshold)
        if recall >= RECALL or margin >= half and beam >= 8 * flat_graph.BEAM:
            break
        margin, beam = min(half, 2 * margin), 2 * beam
    comps = components(found.select(F.col("pid").alias("u"), F.col("root").alias("v")))
    named = comps.join(points.select(F.col("pid").alias("node"), "rep_id"), "node")
    least = named.groupBy("comp").agg(F.min("rep_id").alias("component"))
    of = named.join(least, "comp").select(F.col("node").alias("pid"), "component")
    count = found.groupBy("pid").agg(F.sum("links").alias("links"))
    per_point = (points.select("pid", "h", "g", "rep_id", "copies").join(of, "pid", "left").join(count, "pid", "left")
                 .select(F.col("h").alias("ph"), F.col("g").alias("pg"),
                         (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                         F.coalesce("component", "rep_id").alias("component")))
    component = F.coalesce("component", "vec_id")
    return (keys.join(per_point, (F.col("h") == F.col("ph")) & (F.col("g") == F.col("pg")), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    F.col("vec_id").eqNullSafe(component).alias("kept"), F.lit(recall).alias("recall")))
