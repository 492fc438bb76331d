"""A robust-pruned flat graph over the unit vectors of one block, and range search on it (numpy, in a task).

Build: from a random graph, two passes (the second with slack ``ALPHA``) search every point from the
medoid, prune what the search met to at most ``DEGREE`` neighbours of different directions, and add the
edges back, pruned again where a point gets too many.  Search: all queries of a block go step by
step through a beam; what is found in range then expands: the neighbours of every point in range
are looked at, until no new one is in range.
"""

from __future__ import annotations

import numpy as np

DEGREE, BEAM, WIDTH, ALPHA = 24, 32, 4, 1.2
CHUNK = 1 << 16
SLACK = 1e-5  # single precision in the search; what is found is checked in double precision


def starts(points: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The medoid, and as long as points can't be reached from the starts, the medoid of those."""
    out, reached = [], np.zeros(len(points), dtype=bool)
    while not reached.all():
        rest = np.flatnonzero(~reached)
        first = rest[(points[rest] @ points[rest].mean(axis=0)).argmax()]
        out.append(first)
        front = np.array([first])
        reached[first] = True
        while len(front):
            to = near[front].ravel()
            to = np.unique(to[to >= 0])
            front = to[~reached[to]]
            reached[front] = True
    return np.array(out, dtype=np.int64)


class _Walk:
    """The state of a search: which points each query has met, and the pairs in range."""

    def __init__(self, points: np.ndarray, near: np.ndarray, queries: np.ndarray, least: float):
        self.points, self.near, self.queries, self.least = points, near, queries, least
        self.met = np.zeros((len(queries), len(points)), dtype=bool)
        self.open = np.zeros_like(self.met)  # in range, neighbours not looked at yet
        self.hits: list[tuple[np.ndarray, np.ndarray]] = []

    def meet(self, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Similarities of pairs met for the first time."""
        sim = np.empty(len(q), dtype=np.float32)
        for lo in range(0, len(q), CHUNK):
            at = slice(lo, lo + CHUNK)
            sim[at] = np.einsum("ij,ij->i", self.queries[q[at]], self.points[p[at]])
        self.met[q, p] = True
        inside = sim >= self.least
        if inside.any():
            self.hits.append((q[inside], p[inside]))
            self.open[q[inside], p[inside]] = True
        return sim


def search(points: np.ndarray, near: np.ndarray, begin: np.ndarray, queries: np.ndarray, least: float = 2.0,
           beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best points of each query, query and point of every pair met with at least ``least``)."""
    n, m = len(points), len(queries)
    walk = _Walk(points, near, queries, least - SLACK)
    begin = begin[:CHUNK]
    first = np.repeat(np.arange(m), len(begin)), np.tile(begin, m)
    sim = walk.meet(*first).reshape(m, -1)
    ids = np.full((m, max(beam, len(begin))), -1, dtype=np.int64)
    sims = np.full(ids.shape, -np.inf, dtype=np.float32)
    ids[:, : len(begin)], sims[:, : len(begin)] = begin, sim
    done = np.zeros(ids.shape, dtype=bool)
    active = np.arange(m)
    while len(active):
        now = np.where(done[active] | (ids[active] < 0), -np.inf, sims[active])
        take = np.argpartition(-now, min(WIDTH, now.shape[1] - 1), axis=1)[:, :WIDTH]
        some = np.take_along_axis(now, take, 1) > -np.inf
        go = some.any(axis=1)
        active, take, some = active[go], take[go], some[go]
        if not len(active):
            break
        done[active[:, None], take] |= some
        node = np.where(some, ids[active[:, None], take], -1)
        walk.open[np.repeat(active, some.sum(axis=1)), node[some]] = False
        to = np.where(node[:, :, None] >= 0, near[node], -1).reshape(len(active), -1)
        to.sort(axis=1)
        fresh = to >= 0
        fresh[:, 1:] &= to[:, 1:] != to[:, :-1]
        fresh &= ~walk.met[active[:, None], to]
        row, col = np.nonzero(fresh)
        new = np.full(to.shape, -np.inf, dtype=np.float32)
        new[row, col] = walk.meet(active[row], to[row, col])
        every = np.concatenate([sims[active], new], axis=1)
        best = np.argpartition(-every, beam - 1, axis=1)[:, : ids.shape[1]]
        ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, to, -1)], axis=1), best, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], np.zeros(to.shape, dtype=bool)], axis=1), best, 1)
        sims[active] = np.take_along_axis(every, best, 1)
    while True:  # range expansion
        q, p = np.nonzero(walk.open)
        if not len(q):
            break
        walk.open[:] = False
        for lo in range(0, len(q), CHUNK):
            to = near[p[lo : lo + CHUNK]]
            pair = (q[lo : lo + CHUNK, None] * n + to)[to >= 0]
            a, b = np.divmod(np.unique(pair[~walk.met.reshape(-1)[pair]]), n)
            walk.meet(a, b)
    order = np.argsort(-sims, axis=1, kind="stable")
    best = np.take_along_axis(np.where(sims > -np.inf, ids, -1), order, 1)
    if not walk.hits:
        return best, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return best, np.concatenate([h[0] for h in walk.hits]), np.concatenate([h[1] for h in walk.hits])


def prune(points: np.ndarray, of: np.ndarray, pool: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """At most ``degree`` neighbours of each point: the nearest of the pool, then the nearest of those
    that no chosen one is nearer to by the factor ``alpha``."""
    pool = np.sort(pool, axis=1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    pool[pool == of[:, None]] = -1
    there = points[pool]
    far = np.where(pool >= 0, 1 - np.einsum("bd,bcd->bc", points[of], there), np.inf)
    order = np.argsort(far, axis=1)[:, : 4 * degree]
    pool, far = np.take_along_axis(pool, order, 1), np.take_along_axis(far, order, 1)
    there = np.take_along_axis(there, order[:, :, None], 1)
    between = alpha * alpha * (1 - there @ there.transpose(0, 2, 1))
    alive, out, rows = pool >= 0, np.full((len(of), degree), -1, dtype=np.int64), np.arange(len(of))
    for r in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, r] = pool[rows, first][some]
        alive &= between[rows, first] > far
        alive[rows, first] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, batch: int = 512, seed: int = 13) -> np.ndarray:
    """Neighbours of each point (-1 where there are fewer)."""
    n, rng = len(points), np.random.Generator(np.random.PCG64(seed))
    near = np.full((n, degree), -1, dtype=np.int64)
    if n < 2:
        return near
    k = min(degree // 2, n - 1)
    near[:, :k] = (np.arange(n)[:, None] + rng.integers(1, n, (n, k))) % n
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            of = order[lo : lo + batch]
            met, _, _ = search(points, near, starts(points, near), points[of], beam=beam)
            near[of] = prune(points, of, np.concatenate([met, near[of]], axis=1), alpha, degree)
            to, back = near[of].ravel(), np.repeat(of, degree)
            to, back = to[to >= 0], back[to >= 0]
            by = np.argsort(to, kind="stable")
            to, back = to[by], back[by]
            target, begin, count = np.unique(to, return_index=True, return_counts=True)
            for top in range(0, int(count.max(initial=0)), degree):  # as many edges back at a time
                mine = np.flatnonzero(count > top)
                wide = np.full((len(mine), degree), -1, dtype=np.int64)
                width = np.minimum(count[mine] - top, degree)
                slot = np.arange(degree) < width[:, None]
                wide[slot] = back[(begin[mine, None] + top + np.arange(degree))[slot]]
                joined = np.concatenate([near[target[mine]], wide], axis=1)
                near[target[mine]] = prune(points, target[mine], joined, alpha, degree)
    return near
