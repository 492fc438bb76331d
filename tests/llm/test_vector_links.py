"""Embedding near-dedup against all pairs."""

import math

import numpy as np
import pytest

from insights.llm import flat_graph, vector_links

SCHEMA = "vec_id long, embedding array<double>, h long, g long, v long, pid long, u string, cells int, copies int"


def brute(rows, threshold=0.95):
    """vec_id, links and component of each row, from all pairs."""
    good = lambda v: v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
    sizes = [len(v) for _, v in rows if good(v)]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    at = [k for k, (_, v) in enumerate(rows) if good(v) and len(v) == d]
    u = np.array([rows[k][1] for k in at], dtype=float).reshape(len(at), max(d, 1))
    u /= np.abs(u).max(axis=1, keepdims=True, initial=1e-323)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(at))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(at))], dtype=int)
        if (new == label).all():
            break
        label = new
    out = [(i, 0, i) for i, _ in rows]
    for k, row in enumerate(at):
        ids = [rows[at[m]][0] for m in np.flatnonzero(label == label[k])]
        out[row] = (rows[row][0], int(near[k].sum()), min((i for i in ids if i is not None), default=None))
    return out


def check(df, exact=True):
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    result = vector_links.near_copies(df).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    got, want = sorted([tuple(r)[:3] for r in result], key=order), sorted(brute(rows), key=order)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in result)
    if exact:
        assert got == want
    assert len(got) == len(want)
    return got, want


def vectors(n, groups, size, seed=1, d=64):
    rng = np.random.default_rng(seed)
    v = list(rng.standard_normal((n, d)))
    for _ in range(groups):
        c = rng.standard_normal(d)
        v += [c + 0.1 * rng.standard_normal(d) for _ in range(size)]
    return [(i, x.tolist()) for i, x in enumerate(v)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "u", 5, 6) for i, v in rows], SCHEMA).repartition(4)


def test_given_vectors(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_groups_and_odd_rows(spark):
    rows = vectors(300, 6, 12)
    v = rows[5][1]
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [None] * 64), (904, [float("nan")] * 64), (905, [1.0, 2.0]),
           (906, v), (907, [2 * c for c in v]), (908, [1e300 * c for c in v]), (909, [1e-300 * c for c in v]), (None, v),
           (None, [-c for c in v]), (10, rows[10][1]), (911, [float("inf"), *v[1:]])]
    check(frame(spark, rows + odd + [(1000 + i, rows[7][1]) for i in range(40)]))


def test_no_vectors(spark):
    check(frame(spark, []))
    check(frame(spark, [(1, None), (2, [0.0, 0.0]), (2, None)]))
    check(frame(spark, [(1, [1.0]), (2, [3.0]), (3, [-1.0])]))


def test_cells_and_blocks(spark, monkeypatch):
    """Small cells and blocks: pairs across borders and blocks come once, copies in range of a hot group too."""
    monkeypatch.setattr(vector_links, "CELL", 64)
    monkeypatch.setattr(vector_links, "BLOCK", 40)
    rows = vectors(200, 10, 15, seed=4)
    rng = np.random.default_rng(9)
    rows += [(5000 + i, (np.array(rows[0][1]) + 0.1 * rng.standard_normal(64)).tolist()) for i in range(150)]
    got, want = check(frame(spark, rows), exact=False)
    assert [r[0] for r in got] == [r[0] for r in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)


def test_links_at_the_threshold(spark):
    """Pairs on a circle at angles just inside and outside of the threshold."""
    base = math.acos(0.95)
    rows = [(k, [math.cos(t), math.sin(t)]) for k, t in enumerate([0.0, base - 1e-9, 2.0, 2.0 + base + 1e-9, 4.0, 4.0 + base / 2, 4.0 + base * 1.2])]
    got, _ = check(frame(spark, rows))
    assert [r[1] for r in got] == [1, 1, 0, 0, 1, 2, 1]


@pytest.mark.parametrize("n", [1, 2, 30, 1500])
def test_graph_recall(n):
    rng = np.random.default_rng(n)
    p = rng.standard_normal((n, 32))
    p[: n // 3] = p[0] + 0.05 * rng.standard_normal((n // 3, 32))
    p = (p / np.linalg.norm(p, axis=1, keepdims=True)).astype(np.float32)
    near = flat_graph.build(p)
    assert (near < n).all() and ((near >= 0).sum(axis=1) <= flat_graph.DEGREE).all() and not (near == np.arange(n)[:, None]).any()
    _, q, r = flat_graph.search(p, near, flat_graph.starts(p, near), p, 0.95)
    assert len(np.unique(q * n + r)) >= 0.99 * ((p @ p.T) >= 0.95).sum()
