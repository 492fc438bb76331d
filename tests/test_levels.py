"""Balances as step functions against plain loops over every day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from insights.operators import balances as K
from insights.operators import levels

DAY = dt.timedelta(1)


@pytest.fixture(scope="module")
def txns(spark):
    rng = random.Random(6)
    day = lambda lo, hi: dt.date(2019, 11, 20) + rng.randint(lo, hi) * DAY
    rows = [(c, day(0, 900), rng.choice(["deposit", "purchase", "withdrawal"]), rng.randint(1, 9999) / 100)
            for c in range(12) for _ in range(rng.choice([1, 2, 15]))]
    rows += [(20, dt.date(2020, 1, 1), "deposit", 5.0), (20, dt.date(2020, 1, 31), "purchase", 7.0), (None, day(0, 900), "deposit", 1.0),
             (21, dt.date(2020, 2, 29), "deposit", 3.0), (21, dt.date(2020, 2, 29), "deposit", 3.0), (22, None, "deposit", 9.0)]
    return spark.createDataFrame(rows, "customer_id long, txn_date date, txn_type string, x double").withColumn(
        "txn_amount", F.col("x").cast("decimal(12,2)"))


def daily(txns):
    """Balance in cents per customer and day."""
    rows = [(r["customer_id"], r["txn_date"], int(r["txn_amount"] * 100) * (1 if r["txn_type"] == "deposit" else -1))
            for r in txns.collect() if r["txn_date"]]
    lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
    days = [lo + k * DAY for k in range((hi - lo).days + 1)]
    return {c: {d: sum(v for k, t, v in rows if k == c and t <= d) for d in days} for c in {r[0] for r in rows}}


def test_dense_balances(spark, txns):
    got = {(r[0], r[1]): float(r[2]) for r in K.daily_running_balance(txns).collect()}
    assert got == {(c, d): pytest.approx(v / 100) for c, of in daily(txns).items() for d, v in of.items()}
    month = {(r[0], r[1]): float(r[2]) for r in K.monthly_balance_dense(txns).collect()}
    want = {}
    for c, of in daily(txns).items():
        for d in sorted(of):
            want[c, d.replace(day=1)] = of[d]
    assert month == {k: pytest.approx(v / 100) for k, v in want.items()}


def test_stats_and_allocations(spark, txns):
    of = daily(txns)
    got = {r[0]: (float(r[1]), r[2], float(r[3])) for r in K.balance_stats(txns).collect()}
    assert got == {c: (min(v.values()) / 100, pytest.approx(sum(v.values()) / len(v) / 100, abs=0.0051), max(v.values()) / 100)
                   for c, v in of.items()}
    days = sorted(next(iter(of.values())))
    months = sorted({d.replace(day=1) for d in days})
    ends = [max(d for d in days if d.replace(day=1) == m) for m in months]
    prev = {r[0]: float(r[1]) for r in K.allocation_prev_month(txns).collect()}
    assert prev == {m: pytest.approx(sum(v[e] for v in of.values()) / 100, abs=0.51) for m, e in zip(months[1:], ends)}
    peak = {r[0]: float(r[1]) for r in K.allocation_realtime(txns).collect()}
    assert peak == {m: pytest.approx(sum(max(v[d] for d in days if d.replace(day=1) == m) for v in of.values()) / 100, abs=0.51)
                    for m in months}
    for n in (30, 7):
        mean = {r[0]: r[1] for r in K.allocation_avg_30d(txns, n).collect()}
        want = {m: sum(sum(w) / len(w) for v in of.values() for w in [[v[d] for d in days if e - n * DAY < d <= e]]) / 100
                for m, e in zip(months, ends)}
        assert mean == {m: pytest.approx(x, abs=0.51) for m, x in want.items()}
    # a wrong window gives another answer on these years of data
    other = {r[0]: r[1] for r in K.allocation_avg_30d(txns, 29).collect()}
    assert other != {r[0]: r[1] for r in K.allocation_avg_30d(txns, 30).collect()}


def test_value_at_dates(spark, txns):
    of, days = daily(txns), [dt.date(2019, 1, 1), dt.date(2020, 1, 30), dt.date(2020, 1, 31), dt.date(2021, 6, 1), dt.date(2030, 1, 1)]
    net = levels.flows(txns, "customer_id", F.col("txn_date"), K.signed_amount())
    got = {(r["key"], r["t"]): int(r["level"] * 100) for r in levels.at_dates(
        levels.steps(net), spark.createDataFrame([(d,) for d in days], "t date")).collect()}
    rows = txns.collect()
    for c, v in of.items():
        first = min(r["txn_date"] for r in rows if r["customer_id"] == c and r["txn_date"])
        for t in days:
            assert got.get((c, t)) == (v[min(t, max(v))] if t >= first else None)


def test_no_transactions(spark, txns):
    none = txns.limit(0)
    for f in (K.daily_running_balance, K.monthly_balance_dense, K.balance_stats, K.allocation_prev_month,
              K.allocation_avg_30d, K.allocation_realtime):
        assert f(none).collect() == []
