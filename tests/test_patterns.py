"""Skew-safe pattern rewrites checked against the plain form on small fixtures."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from insights.operators import patterns as P
from insights.operators.selection import exact_quantiles
from insights.operators.loyalty import rank_by


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rank_by_equals_window_rank(spark):
    rnd = random.Random(7)
    # one hot key holding most rows, plus small keys
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 9)}", rnd.randint(0, 20), i) for i in range(600)]
    df = spark.createDataFrame(data, "k string, d int, i int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("d")))
    got = rank_by(df, ["k"], "d", "r")
    assert _rows(got, ["k", "d", "i", "r"]) == _rows(want, ["k", "d", "i", "r"])


def test_top_k_with_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 9, 9, 7, 3, 9, 1, 7])], "i int, v int")
    top = P.top_k_with_ties(df, "v", 2)          # 2nd best value is 9 → all three 9s
    assert sorted(r.i for r in top.collect()) == [1, 2, 5]
    top4 = P.top_k_with_ties(df, "v", 4)          # 4th best is 7 → 9,9,9,7,7
    assert sorted(r.v for r in top4.collect()) == [7, 7, 9, 9, 9]
    low = P.top_k_with_ties(df, "v", 1, descending=False)
    assert [r.v for r in low.collect()] == [1]


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 2)], "g string, k string, v int")
    s = P.share_of_total(df, "v", "p", group="g").collect()
    by = {}
    for r in s:
        by.setdefault(r.g, 0.0)
        by[r.g] += r.p
    assert by == {"a": 100.0, "b": 100.0}


def test_dense_running_total(spark):
    import datetime as dt
    d = dt.date
    df = spark.createDataFrame([(1, d(2024, 1, 1), 5), (1, d(2024, 1, 3), -2), (2, d(2024, 1, 2), 4)],
                               "c int, t date, v int")
    out = P.dense_running_total(df, "c", "t", F.col("v"), "day", "day", "bal")
    rows = _rows(out, ["c", "day", "bal"])
    assert rows == [(1, d(2024, 1, 1), 5), (1, d(2024, 1, 2), 5), (1, d(2024, 1, 3), 3),
                    (2, d(2024, 1, 1), 0), (2, d(2024, 1, 2), 4), (2, d(2024, 1, 3), 4)]


def test_top_k_per_group_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2)], "g string, v int")
    got = _rows(P.top_k_per_group(df, "g", [F.col("v").desc()], 1, ties=True), ["g", "v"])
    assert got == [("a", 3), ("a", 3), ("b", 2)]


def test_exact_quantiles_match_percentile(spark):
    rnd = random.Random(3)
    probs, names = [0.0, 0.25, 0.5, 0.8, 0.95, 1.0], ["a", "b", "c", "d", "e", "f"]
    for hot, n in ((0.33, 3001), (0.9, 2000), (0.0, 1), (0.0, 2), (0.5, 4)):
        vals = [500 if rnd.random() < hot else rnd.randint(-2000, 2000) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v,) for v in vals], "s long")
        got = exact_quantiles(df, "s", probs, names).collect()[0]
        want = df.agg(*[F.percentile("s", p).alias(n) for p, n in zip(probs, names)]).collect()[0]
        assert [got[n] for n in names] == [want[n] for n in names]


def test_previous_by_equals_lag(spark):
    rnd = random.Random(11)
    data = [("hot" if rnd.random() < 0.4 else f"c{rnd.randint(0, 30)}", rnd.randint(0, 50), i, rnd.randint(0, 4))
            for i in range(1500)]
    df = spark.createDataFrame(data, "k string, d int, i int, p int")
    want = df.withColumn("was", F.lag("p").over(Window.partitionBy("k").orderBy("d", "i")))
    got = P.previous_by(df, "k", "d", "i", "p", "was")
    cols = ["k", "d", "i", "p", "was"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(_rows_any(got, cols), key=key) == sorted(_rows_any(want, cols), key=key)


def _rows_any(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_recommended_conf_scales_partitions(spark):
    from insights.plans.session import input_bytes, recommended_conf

    small = recommended_conf(10 << 20)
    big = recommended_conf(100 << 40)                      # 100 TB
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert input_bytes(spark, ["/root/testdata/sf0.001/orders.parquet"]) > 0
