"""Embedding whitening against plain integers and a dense eigensolver."""

import math

import numpy as np
import pytest

from insights.llm import feast, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, v int, n long, component string"


def check(df, k=16):
    rows = [r for r in df.select("vec_id", "embedding").collect() if r[1] is not None
            and all(c is not None and math.isfinite(c) for c in r[1])]
    sizes = [len(r[1]) for r in rows]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    rows = [(r[0], tuple(math.floor(64 * float(c)) + 1_000_000 for c in r[1])) for r in rows if len(r[1]) == d]
    got = whitening.whiten(df, k).collect()
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit]).reshape(n, d)
    v = y.T @ y / max(n, 1)
    e = np.linalg.eigvalsh(v)[::-1][:k] if d and n else np.empty(0)
    e = e[e > 1e-9 * max(e[0], 1e-300)] if len(e) else e
    assert len(got) == len(rows) * len(e)
    dev = {x: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in rows}
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["deviation"]) for r in got) == sorted(
        (i is None, i or 0, c + 1, dev[x] if dev[x] < 1 << 63 else None) for i, x in rows for c in range(len(e)))
    by = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-8
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-6)
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r["whitened"])
    return got, by, rows, e


def test_real_vectors(spark):
    _, by, rows, e = check(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    assert len(e) == 16
    w = np.array([[by[i][c + 1][0] for c in range(16)] for i, _ in rows])
    distinct = np.array([w[k] for k in {x: k for k, (_, x) in enumerate(rows)}.values()])
    assert np.abs(np.cov(distinct.T, bias=True) - np.eye(16)).max() < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = [(i, [float(c) for c in rng.normal(0, [3, 2, 1, 0.5])]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0]), (None, [1.0, 2.0, 3.0, 4.0]), (0, base[0][1]), (7, base[1][1]), (106, [0.0, -0.0, 0.0, 1e-300])]
    copies = [(200 + i, base[2][1]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3, "c") for i, v in base + odd + copies], SCHEMA).repartition(3)
    check(df)
    check(df, 2)


def test_few_or_no_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(*r, 1, "x", 2, 3, "c") for r in rows], SCHEMA)
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        assert whitening.whiten(frame(rows)).collect() == []
    check(frame([(1, [2.0, 3.0]), (2, [2.5, 3.0]), (3, [9.0, 3.0])]))  # one component only


def test_great_entries(spark):
    rows = [(i, [float(i), float(i * i % 7), 1e3 * (i % 3)]) for i in range(20)] + [(50, [1e300, -1e300, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got if r["vec_id"] == 50} == {None}


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), np.repeat([5.0, 3.0, 1.0, 0.5], 10), np.r_[np.zeros(30), np.arange(1.0, 8.0)],
    np.ones(24), np.repeat(np.arange(1.0, 16.0), 2) + np.tile([0, 1e-10], 15), 2.0 ** -np.arange(60.0), np.array([3.0])])
def test_contour_integration_finds_every_leading_pair(values):
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, u = feast.leading(v, 16)
    want = np.linalg.eigvalsh(v)[::-1]
    want = want[want > 1e-13 * want[0]][:16]
    assert len(e) == len(want) and np.allclose(e, want, rtol=1e-10, atol=1e-14 * want[0])
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ u - u * e).max() < 1e-13 * want[0] * len(values)
    assert (feast.Inertia(v).below(np.array([-1.0, want[0] * 2])) == [0, len(values)]).all()
