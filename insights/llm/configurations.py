"""The configuration linear program of packing, over a histogram of lengths.

A configuration is a multiset of lengths that fits one sequence; the program covers
the histogram by as few configurations as it can.  Multiplicative weights solve it:
every length has a weight that falls by a factor as it gets covered; the price of a
length is length times weight, and the best configuration at these prices comes out
of a knapsack dynamic program over the capacity, with others as good at the same prices
that share no length with it.  A round takes as much of a configuration as the scarcest of
its lengths allows, so each configuration finishes a length and there are at most as many
as lengths; the rounds end when less than ``REST`` of the tokens is left.  Rounding takes the whole multiples of each configuration, and one more
with the probability of the fraction (seeded), as far as the pieces reach; what rounding
leaves goes through the program again while that places something.  The last few pieces
are placed by best fit, longest first, into the gaps and into new sequences, whole groups
of equal sequences at a time.

Everything here works on the histogram, at most ``capacity`` numbers, never on the
pieces themselves, so its work doesn't grow with the corpus.
"""

from __future__ import annotations

import numpy as np

RATE = 2.0
#: share of the tokens that the program may leave to best fit
REST = 0.02
#: times that the program goes over what rounding left
PASSES = 4
#: configurations of one round, and how much cheaper than the best one they may be
LANES, NEAR = 32, 0.01

Group = tuple[dict[int, int], int]


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int, most: int = 1) -> list[dict[int, int]]:
    """The multiset of lengths of highest price within the capacity, and up to ``most`` - 1 others at the
    same prices that share no length with it or one another and are at most ``NEAR`` cheaper."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    reach = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := reach[c]:
            value = best[c - lengths[:k]] + prices[:k]
            i = value.argmax()
            if value[i] > best[c]:
                best[c], took[c] = value[i], i
    fits = lengths[: reach[capacity]]
    first = best[capacity - fits] + prices[: len(fits)]  # the best multiset that holds each length
    out: list[dict[int, int]] = []
    used: set[int] = set()
    for i in np.argsort(-first, kind="stable").tolist():
        if len(out) == most or first[i] < (1 - NEAR) * best[capacity]:
            break
        config, c = {int(lengths[i]): 1}, capacity - int(lengths[i])
        while c > 0:
            if took[c] < 0:
                c -= 1
            else:
                n = int(lengths[took[c]])
                config[n] = config.get(n, 0) + 1
                c -= n
        if used.isdisjoint(config):
            out.append(config)
            used.update(config)
    return out


def solve(histogram: dict[int, int], capacity: int) -> list[Group]:
    """(configuration, multiples) pairs that cover the histogram exactly."""
    groups, left = program(histogram, capacity)
    return best_fit(groups, left, capacity)


def program(histogram: dict[int, int], capacity: int) -> tuple[list[Group], np.ndarray]:
    """The rounded answer of the configuration program, and how many pieces of each length it leaves."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in histogram.items():
        if not 0 < n <= capacity:
            raise ValueError(f"length {n} doesn't fit {capacity}")
        left[n] = k
    size = np.arange(capacity + 1)
    allowed, rng = REST * float(left @ size), np.random.Generator(np.random.PCG64(2048))
    taken: dict[tuple[tuple[int, int], ...], int] = {}
    if left[capacity]:
        taken[((capacity, 1),)] = int(left[capacity])
        left[capacity] = 0
    for _ in range(PASSES):
        if left @ size <= allowed:
            break
        placed = 0
        for config, x in fractional(left, capacity, allowed):
            whole = int(x) + int(rng.random() < x - int(x))
            if m := min([whole, *(int(left[n]) // a for n, a in config)]):
                for n, a in config:
                    left[n] -= a * m
                taken[config] = taken.get(config, 0) + m
                placed += m
        if not placed:
            break
    return [(dict(config), m) for config, m in taken.items()], left


def fractional(demand: np.ndarray, capacity: int, allowed: float) -> list[tuple[tuple[tuple[int, int], ...], float]]:
    """Multiplicative weights: (configuration, fractional multiples), largest multiples first, until no more
    than ``allowed`` tokens are left."""
    left = demand.astype(float)
    found: dict[tuple[tuple[int, int], ...], float] = {}
    while True:
        lengths = np.flatnonzero(left > 0)
        if not len(lengths) or left[lengths] @ lengths <= allowed:
            break
        covered = 1 - left[lengths] / demand[lengths]
        for config in knapsack(lengths, lengths * np.exp(-RATE * (covered - covered.min())), capacity, LANES):
            share = {n: left[n] / a for n, a in config.items()}
            x = min(share.values())
            for n, a in config.items():
                left[n] = 0.0 if share[n] == x else left[n] - a * x
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + x
    return sorted(found.items(), key=lambda g: -g[1])


def best_fit(groups: list[Group], left: np.ndarray, capacity: int) -> list[Group]:
    """Place what is left, longest first, each into the smallest gap that holds it."""
    gaps: dict[int, list[Group]] = {}
    for config, m in groups:
        gaps.setdefault(capacity - sum(n * a for n, a in config.items()), []).append((config, m))
    open_gaps = np.zeros(capacity + 1, dtype=bool)
    open_gaps[[g for g in gaps]] = True
    for n in map(int, np.flatnonzero(left)[::-1]):
        k = int(left[n])
        while k:
            at = n + int(open_gaps[n:].argmax())
            if not open_gaps[at]:
                per = min(capacity // n, k)
                for a, m in ((per, k // per), (k % per, 1)):
                    if a and m:
                        gaps.setdefault(capacity - n * a, []).append(({n: a}, m))
                        open_gaps[capacity - n * a] = True
                break
            config, m = gaps[at].pop()
            per = min(at // n, k)
            use = min(m, k // per)
            if m > use:
                gaps[at].append((config, m - use))
            grown = config | {n: config.get(n, 0) + per}
            gaps.setdefault(at - n * per, []).append((grown, use))
            open_gaps[at], open_gaps[at - n * per] = bool(gaps[at]), True
            k -= per * use
    return [g for same in gaps.values() for g in same]
