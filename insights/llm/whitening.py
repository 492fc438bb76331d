"""Embedding whitening: principal components by contour integration, rows scaled to unit variance.

Entries become integers x = floor(64 c) + 1000000.  The fit list holds each distinct integer
vector once, so a vector that a third of all rows share weighs as one.  One pass over it gives
the exact sums, a second the covariance of the centred vectors (a matrix per task, added up
row by row across tasks); ``feast.leading`` finds the components of that matrix; a third pass
measures the covariance of the whitened fit list.  Every row is then projected inside its task.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, and so
are vectors of another length than the commonest; entries beyond 2^46 count as that bound; a
null vec_id stays null and rows that repeat come back each; components whose variance is zero to
rounding are left out, so a table of no or one distinct vector gives no row; a ``deviation``
beyond a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insights.llm import feast
from insights.llm.vectors import dimension, finite, matrix
from insights.plans.sinks import materialize

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
BOUND = float(1 << 46)
BATCH = 4096


def integers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, x: the vectors that count, as integers."""
    c = rows[vector].cast("array<double>")
    x = F.transform("v", lambda e: F.floor(F.greatest(F.least(e, F.lit(BOUND)), F.lit(-BOUND)) * SCALE) + F.lit(SHIFT))
    return (rows.select(rows[vec_id].cast("long").alias("vec_id"), c.alias("v")).filter(finite(F.col("v")))
            .select("vec_id", x.alias("x")))


@dataclass(frozen=True)
class Whitener:
    """What the fit list gives: its size, sums, components (columns) and variances."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * d, [0] * d
        for b in batches:
            x = matrix(b.column("x"), d)
            n += len(x)
            high = [a + int(s) for a, s in zip(high, (x >> 26).sum(axis=0), strict=True)]
            low = [a + int(s) for a, s in zip(low, (x & ((1 << 26) - 1)).sum(axis=0), strict=True)]
        if n:
            total = [Decimal((h << 26) + lo) for h, lo in zip(high, low, strict=True)]
            yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array(total, pa.decimal128(38, 0)),
                                   pa.array([n] * d, pa.int64())], names=["i", "s", "n"])

    rows = fit.mapInArrow(run, "i int, s decimal(38,0), n long").groupBy("i").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # one row per dimension
    at = {r["i"]: (int(r["s"]), r["n"]) for r in rows}
    return (at[0][1] if at else 0), [at[i][0] for i in range(d)] if at else [0] * d


def _centred(x: np.ndarray, n: int, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (x - whole).astype(float) - part


def _mean(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and the rest below one."""
    return np.array([s // n for s in sums], dtype=np.int64), np.array([(s % n) / n for s in sums])


def _products(fit: DataFrame, n: int, sums: tuple[int, ...], onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred fit list, or of its projections ``onto`` the columns of a matrix.

    A task adds up its batches to one matrix and gives its rows; tasks' matrices are added row by row."""
    d = len(sums)
    whole, part = _mean(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = matrix(b.column("x"), d)
            for lo in range(0, len(x), BATCH):
                z = _centred(x[lo : lo + BATCH], n, whole, part)
                z = z if onto is None else z @ onto
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                                  names=["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for b in batches:
            for i, r in zip(b.column("i").to_numpy(), matrix(b.column("row"), d if onto is None else onto.shape[1]), strict=True):
                rows[i] = rows[i] + r if i in rows else r.copy()
        if rows:
            yield pa.record_batch([pa.array(list(rows), pa.int32()), pa.array([r.tolist() for r in rows.values()], pa.list_(pa.float64()))],
                                  names=["i", "row"])

    schema = "i int, row array<double>"
    rows = fit.mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect()  # one row per dimension
    v = np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])]) / n
    return (v + v.T) / 2


def fit_whitener(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of the distinct integer vectors (column x); None if there is no vector or no component."""
    d = dimension(vectors, "x")
    if not d:
        return None
    fit = materialize(vectors.filter(F.size("x") == d).select("x").distinct(), "fit")
    n, sums = _sums(fit, d)
    v = _products(fit, n, sums)
    e, u = feast.leading(v, components)
    if not len(e):
        return None
    error = np.abs(_products(fit, n, sums, u / np.sqrt(e)) - np.eye(len(e))).max()
    return Whitener(n, tuple(sums), u, e, float(np.trace(v)), float(error))


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None where it is beyond a long."""
    whole, part = _mean(n, sums)
    most = float(np.abs(x - whole).max(initial=0)) + 1
    if (most * n) ** 2 * max(1, x.shape[1]) < 2.0 ** 62:
        # n x - S = n (x - whole) - rest, which fits where its square does
        y = (x - whole) * n - np.array([s % n for s in sums], dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return [t if t < 1 << 63 else None for t in exact]


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: see the contract of op11."""
    vectors = integers(rows, vec_id, vector)
    w = fit_whitener(vectors, components)
    if w is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    whole, part = _mean(w.n, w.sums)
    k, onto = len(w.variances), w.components / np.sqrt(w.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                b = batch.slice(lo, BATCH)
                x = matrix(b.column("x"), w.dimension)
                white, m = _centred(x, w.n, whole, part) @ onto, len(x)
                yield pa.record_batch([
                    b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n)),
                    pa.array(_deviations(x, w.n, w.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(white.reshape(-1)), pa.array(np.tile(w.variances / w.total, m)),
                    pa.array(np.full(m * k, w.identity_error))], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return vectors.filter(F.size("x") == w.dimension).mapInArrow(run, SCHEMA)
