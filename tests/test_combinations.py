"""Most frequent combinations against all combinations of every basket."""

import itertools
import random
from collections import Counter

import pytest

from insights.operators.combinations import combinations


def brute(rows, size, k):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = Counter(c for items in baskets.values() for c in itertools.combinations(sorted(items), size))
    return sorted(((*c, m) for c, m in n.items()), key=lambda r: (-r[-1], r[:-1]))[:k]


def check(spark, rows, size, k, **kw):
    df = spark.createDataFrame(rows, "basket string, item long")
    got = [tuple(r) for r in combinations(df, "basket", "item", size, k, **kw).best.collect()]
    assert sorted(got, key=lambda r: (-r[-1], r[:-1])) == brute(rows, size, k)


@pytest.mark.parametrize("size,k", [(2, 3), (3, 1), (3, 8), (4, 2)])
def test_equals_brute_force(spark, size, k):
    rng = random.Random(size * 10 + k)
    weights = [1 / (j + 1) for j in range(30)]
    rows = [(f"b{b}", i) for b in range(40) for i in rng.choices(range(30), weights, k=rng.randint(0, 9))]
    check(spark, rows + [("b1", None), (None, 3), ("b1", 4), ("b1", 4)], size, k)


def test_no_combination_repeats(spark):
    check(spark, [(f"b{b}", b * 7 + j) for b in range(9) for j in range(6)], 3, 5)
    check(spark, [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 9), ("c", 0), ("c", 4), ("c", 5)], 2, 4)


def test_a_narrow_beam_changes_nothing(spark):
    rng = random.Random(5)
    check(spark, [(f"b{b}", i) for b in range(30) for i in rng.sample(range(12), 5)], 3, 4, beam=1)


def test_few_or_no_baskets(spark):
    check(spark, [], 3, 1)
    check(spark, [("a", 1), ("a", 2)], 3, 2)
    check(spark, [("a", 1), ("a", 2), ("a", 3)], 3, 5)


def test_large_baskets_without_all_triples(spark):
    """Baskets of 500 products hold 20 million triples each; a few hundred rows are counted."""
    rng = random.Random(3)
    rows = [(f"b{b}", i) for b in range(12) for i in rng.sample(range(100, 20_000), 500)]
    rows += [(f"b{b}", i) for b in range(12) for i in (1, 2, 3)] + [(f"b{b}", 4) for b in range(6)]
    c = combinations(spark.createDataFrame(rows, "basket string, item long"), "basket", "item", 3, 1)
    assert [tuple(r) for r in c.best.collect()] == [(1, 2, 3, 12)]
    assert c.bound == 12 and c.levels == [36, 12]
