"""Interval join against all pairs."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from insights.operators.intervals import interval_join

EPOCH = dt.datetime(1995, 3, 1)


def frames(spark, points, windows, kind):
    p = spark.createDataFrame([(i, t) for i, t in enumerate(points)], f"point long, t {kind}")
    w = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(windows)], f"window long, a {kind}, b {kind}")
    return p, w


@pytest.mark.parametrize("salts", [1, 3])
def test_timestamps(spark, salts):
    rng = random.Random(salts)
    at = lambda days: EPOCH + dt.timedelta(seconds=rng.randint(0, days * 86400))
    points = [at(3000) for _ in range(300)] + [EPOCH] * 40 + [None]
    windows = []
    for length in (0, 1, 15, 16, 17, 300, 5000):
        windows += [(a, a + dt.timedelta(seconds=rng.randint(0, max(1, length * 86400)))) for a in (at(3000) for _ in range(12))]
    windows += [(EPOCH, EPOCH), (EPOCH, None), (None, EPOCH), (EPOCH + dt.timedelta(1), EPOCH), windows[0]]
    p, w = frames(spark, points, windows, "timestamp_ntz")
    got = sorted((r["point"], r["window"]) for r in interval_join(p, w, "t", "a", "b", salts).collect())
    assert got == sorted((i, j) for i, t in enumerate(points) for j, (a, b) in enumerate(windows)
                         if None not in (t, a, b) and a <= t <= b)


def test_dates_before_1970_and_long_windows(spark):
    days = [dt.date(1960, 1, 1) + dt.timedelta(k * 37) for k in range(400)]
    windows = [(dt.date(1900, 1, 1), dt.date(2100, 1, 1)), (dt.date(1965, 5, 5), dt.date(1965, 5, 5)),
               (dt.date(1969, 12, 31), dt.date(1970, 1, 1)), (days[3], days[3]), (dt.date(1950, 1, 1), dt.date(1981, 7, 9))]
    p, w = frames(spark, days, windows, "date")
    got = sorted((r["point"], r["window"]) for r in interval_join(p, w, "t", "a", "b").collect())
    assert got == sorted((i, j) for i, t in enumerate(days) for j, (a, b) in enumerate(windows) if a <= t <= b)


def test_many_overlapping_windows(spark):
    """100,000 windows: counts per window equal a search in the sorted points; the plan has no nested loop."""
    p = spark.range(20_000).select("id", F.expr("timestamp_ntz'1992-01-01' + make_interval(0,0,0,0,0,0,(id * 7919 % 2400) * 86400 + id % 86400)").alias("t"))
    w = (spark.range(100_000).select(F.col("id").alias("wid"), F.expr(
        "timestamp_ntz'1992-01-01' + make_interval(0,0,0,0,0,0,(id * 104729 % 2400) * 86400 + id % 977)").alias("a"))
        .withColumn("b", F.expr("a + make_interval(0,0,0,0,0,0, 3600 * (1 + wid % 36))")))
    joined = interval_join(p, w, "t", "a", "b").groupBy("wid").agg(F.count(F.lit(1)).alias("n"))
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    got = {r["wid"]: r["n"] for r in joined.collect()}
    t = np.sort(p.toPandas()["t"].to_numpy())
    pdf = w.toPandas()
    n = np.searchsorted(t, pdf["b"].to_numpy(), side="right") - np.searchsorted(t, pdf["a"].to_numpy())
    assert got == {int(i): int(c) for i, c in zip(pdf["wid"], n) if c}
