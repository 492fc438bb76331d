"""Quantiles from stored daily summaries: rank error against all rows, merging, small and empty days."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from insights.operators import sketches as K

PROBS, NAMES = (0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0), list("abcdefg")


def rows():
    rng = random.Random(4)
    kinds = {"flat": lambda: rng.randint(0, 10 ** 6), "ties": lambda: rng.choice([5, 5, 5, 5, rng.randint(0, 9)]),
             "wide": lambda: int(10 ** rng.uniform(0, 15)) * rng.choice([-1, 1])}
    out = [(g, d, f()) for g, f in kinds.items() for d in range(12) for _ in range(rng.choice([1, 7, 20, 900, 2500]))]
    return out + [("flat", 3, None), (None, None, 8), (None, None, 9), ("none", 1, None)]


@pytest.mark.parametrize("points", [20, 200])
def test_rank_error_is_below_one_step(spark, points):
    df = spark.createDataFrame(rows(), "kind string, day long, x long").repartition(5)
    stored = K.summaries(df, "day", "x", ["kind"], points)
    assert stored.groupBy("kind", "day").count().agg(F.max("count")).first()[0] <= points
    for name, keep in (("all", lambda d: True), ("some", lambda d: d is not None and 2 <= d < 9)):
        days = stored if name == "all" else stored.filter("day between 2 and 8")
        got = {r["kind"]: r for r in K.merged_quantiles(days, "x", ["kind"], PROBS, NAMES).collect()}
        for g in {r[0] for r in rows()}:
            xs = sorted(x for h, d, x in rows() if h == g and x is not None and keep(d))
            if not xs:
                assert g not in got
                continue
            assert got[g]["rows"] == len(xs)
            for p, n in zip(PROBS, NAMES):
                low, high = bisect.bisect_left(xs, got[g][n]), bisect.bisect_right(xs, got[g][n])
                assert low < high, "a quantile is one of the values"
                assert low - 1 <= p * len(xs) <= high + 1e-9 or min(abs(p * len(xs) - low), abs(p * len(xs) - high)) \
                    < len(xs) / points, (g, p)


def test_few_rows_are_exact(spark):
    df = spark.createDataFrame([(d, x) for d in range(5) for x in range(d, 40, 3)], "day long, x long")
    xs = sorted(x for d in range(5) for x in range(d, 40, 3))
    got = K.merged_quantiles(K.summaries(df, "day", "x"), "x", [], PROBS, NAMES).first()
    assert [got[n] for n in NAMES] == [xs[max(0, -(-int(p * 1000) * len(xs) // 1000) - 1)] for p in PROBS]


def test_nothing(spark):
    none = spark.createDataFrame([], "day long, x long")
    assert K.merged_quantiles(K.summaries(none, "day", "x"), "x", [], (0.5,), ["m"]).collect() == []
