"""Iceberg cube against every grouping by hand."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from insights.operators.cubes import iceberg_cube

DIMS = ["a", "b", "c"]


def brute(rows, share):
    total, out = sum(r[3] for r in rows), {}
    for k in range(len(DIMS) + 1):
        for fixed in itertools.combinations(range(len(DIMS)), k):
            sums = defaultdict(lambda: [0, 0])
            for r in rows:
                key = tuple(("(none)" if r[j] is None else str(r[j])) if j in fixed else "(all)" for j in range(len(DIMS)))
                sums[key][0] += r[3]
                sums[key][1] += r[4]
            out |= {(*key, k): tuple(v) for key, v in sums.items() if v[0] >= share * total}
    return out


@pytest.mark.parametrize("share", [0.0, 0.03, 0.2, 1.0])
def test_equals_every_grouping(spark, share):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "x", "y", None]), rng.randint(0, 30) if rng.random() < 0.5 else 7, rng.choice(["p", "q", "(r)"]),
             rng.randint(0, 9), rng.randint(-5, 5)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b int, c string, s long, m long")
    got = iceberg_cube(df, DIMS, F.col("s"), share, {"m": F.col("m")}).collect()
    assert {(r["a"], r["b"], r["c"], r["n_fixed"]): (r["support"], r["m"]) for r in got} == brute(rows, share)
    assert len(got) == len(brute(rows, share))


def test_rare_values_are_not_expanded(spark):
    """100,000 rare values: the cube is built from a handful of rows."""
    df = spark.range(100_000).select(F.concat(F.lit("v"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))).alias("a"),
                                     (F.col("id") % 3).alias("b"), F.lit(1).alias("c"))
    got = iceberg_cube(df, DIMS, F.lit(1), 0.1).collect()
    assert len(got) == 2 * (1 + 3 + 1 + 3)


def test_no_rows(spark):
    assert iceberg_cube(spark.createDataFrame([], "a int, b int, c int"), DIMS, F.lit(1), 0.5).collect() == []
