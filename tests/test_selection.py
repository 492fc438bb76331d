"""Exact selection, quantiles and ranks against Spark's own aggregates and windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from insights.operators import selection as S

PROBS, NAMES = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0), list("abcdefg")


def values(kind, n=4000):
    rng = random.Random(kind)
    return {"even": list(range(n)), "ties": [7] * (9 * n // 10) + [rng.randint(-5, 5) for _ in range(n // 10)],
            "wide": [rng.choice([-1, 1]) * rng.randint(0, 2 ** rng.randint(1, 61)) for _ in range(n)], "one": [-3],
            "two": [5, -(1 << 61)], "nulls": [None, 4, None, 9, 4]}[kind]


@pytest.mark.parametrize("kind", ["even", "ties", "wide", "one", "two", "nulls"])
def test_quantiles(spark, kind):
    df = spark.createDataFrame([(v,) for v in values(kind)], "x long")
    got = S.exact_quantiles(df, "x", PROBS, NAMES).first()
    kept = sorted(v for v in values(kind) if v is not None)
    for p, n in zip(PROBS, NAMES):
        pos = (len(kept) - 1) * p
        lo, hi = float(kept[int(pos)]), float(kept[min(int(pos) + (pos > int(pos)), len(kept) - 1)])
        assert got[n] == pytest.approx(lo + (hi - lo) * (pos - int(pos)), rel=1e-12)


def test_quantiles_by_group(spark):
    rng = random.Random(8)
    rows = [(g if g != "none" else None, rng.randint(-10 ** (3 + k), 10 ** (3 + k)))
            for k, g in enumerate(["a", "b", "none"]) for _ in range(500)]
    df = spark.createDataFrame(rows + [("a", 5)] * 3000 + [("c", None), ("d", 1)], "g string, x long")
    got = {r["g"]: tuple(r)[1:] for r in S.exact_quantiles_by(df, ["g"], "x", PROBS, NAMES).collect()}
    want = df.filter("x is not null").groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, PROBS))).alias("q"))
    assert got == {r["g"]: pytest.approx(tuple(r["q"])) for r in want.collect()}


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x long")
    assert [tuple(r) for r in S.exact_quantiles(none, "x", (0.5,), ["m"]).collect()] == [(None,)]
    assert S.exact_quantiles_by(none, ["g"], "x", (0.5,), ["m"]).collect() == []


def test_no_window_over_rows(spark):
    """The largest window partition of a round holds bins, 65,536 at most, however many values there are."""
    df = spark.range(300_000).select((F.col("id") * 1_000_003 % 9_999_991).alias("x"))
    assert S.exact_quantiles(df, "x", (0.5,), ["m"]).first()["m"] == df.agg(F.percentile("x", 0.5)).first()[0]
    plan = S.exact_quantiles(df, "x", (0.5,), ["m"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == S.ROUNDS and all("bin#" in w for w in plan.split("\n") if "Window " in w)


@pytest.mark.parametrize("kind", ["even", "ties", "wide", "one", "nulls"])
def test_global_ranks(spark, kind):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values(kind, 1500))], "id long, x long").repartition(5)
    up, down = Window.orderBy(F.col("x").asc_nulls_first()), Window.orderBy(F.col("x").desc_nulls_last())
    want = df.select("id", "x", F.rank().over(up), F.rank().over(down), F.dense_rank().over(up))
    got = S.global_ranks(df, "x", "up", "down", "dense")
    assert got.columns == ["id", "x", "up", "down", "dense"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_global_ranks_of_nothing(spark):
    assert S.global_ranks(spark.createDataFrame([], "id long, x double"), "x").collect() == []
