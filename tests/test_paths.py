"""Ordered paths against a plain scan of each key's events."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from insights.operators import paths as P
from insights.operators import subscription as S

STEPS = ("a", "b", "c")


def plain(events, steps, direct):
    """Least span and steps behind the key at its end, by trying every choice of events."""
    best, ends = None, {0}
    for n in range(1, len(steps) + 1):
        for pick in itertools.combinations(range(len(events)), n):
            if any(events[i][1] != s for i, s in zip(pick, steps)):
                continue
            if any(j in direct and pick[j] != pick[j - 1] + 1 for j in range(1, n)):
                continue
            if n == len(steps):
                span = events[pick[-1]][0] - events[pick[0]][0]
                best = span if best is None else min(best, span)
                ends.add(n)
            elif n not in direct or pick[-1] == len(events) - 1:
                ends.add(n)
    return max(ends), best


@pytest.mark.parametrize("direct", [(), (1,), (2,), (1, 2)])
def test_paths_equal_a_plain_scan(spark, direct):
    rng = random.Random(sum(direct))
    rows = [(key, rng.randint(-20, 60), n, rng.choice("abcx")) for key in [1, 2, 3, 4, 5, None] for n in range(14)]
    rows += [(9, 5, 0, "x"), (10, None, 0, "a"), (11, 3, 0, "a"), (12, 3, 0, "c"), (12, 3, 1, None)]
    rows += [(20, n, n, "abc"[n % 3]) for n in range(3000)]  # a busy key, over all ranges
    df = spark.createDataFrame(rows, "k long, t long, n long, what string").repartition(7)
    got = P.ordered_paths(df, "k", F.col("t"), ["n"], [F.col("what") == s for s in STEPS], direct)
    found = {r["k"]: (r["reached"], r["span"]) for r in got.collect()}
    for key in [1, 2, 3, 4, 5, None, 9, 11, 12]:
        own = [(t, w) for k, t, n, w in sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: r[1:3])]
        if not direct and not any(w in STEPS for _, w in own):
            assert key not in found
        else:
            assert found[key] == plain(own, STEPS, direct), key
    assert found[20] == (3, 2) and 10 not in found


def test_single_step_and_overlapping_steps(spark):
    df = spark.createDataFrame([(1, 4, 0, "a"), (1, 9, 1, "a"), (1, 11, 2, "a")], "k long, t long, n long, what string")
    one, two = [F.col("what") == "a"], [F.col("what") == "a"] * 2
    assert [tuple(r) for r in P.ordered_paths(df, "k", F.col("t"), ["n"], one).collect()] == [(1, 1, 0)]
    assert [tuple(r) for r in P.ordered_paths(df, "k", F.col("t"), ["n"], two).collect()] == [(1, 2, 2)]
    assert P.ordered_paths(df.limit(0), "k", F.col("t"), ["n"], one).collect() == []


def test_stretches_are_whole_products():
    rng = np.random.default_rng(3)
    group = np.repeat(np.arange(6), [1, 2, 3, 7, 1, 16])
    m = P.matrices(rng.integers(0, 8, 30), rng.integers(0, 99, 30).astype(float), 3, ())
    got = P.stretches(m.copy(), group)
    for g in range(6):
        own = m[group == g]
        want = own[:1]
        for x in own[1:]:
            want = P.product(want, x[None])
        assert (got[g] == want[0]).all()


def test_a_busy_key_is_several_tasks(spark):
    """One key's events are dealt over the ranges; a task hands on one matrix for it."""
    df = spark.range(200_000).select(F.lit(7).alias("k"), "id", F.when(F.col("id") == 10, "a")
                                     .when(F.col("id") == 150_000, "b").alias("what"))
    steps = [F.col("what") == "a", F.col("what") == "b", F.col("id") > 100]
    got = P.ordered_paths(df, "k", F.col("id"), [], steps, direct=(2,))
    assert tuple(got.first()) == (7, 3, 149_991)
    with pytest.raises(ValueError):
        P.ordered_paths(df, "k", F.col("id"), [], steps, direct=(3,))


def test_downgrades_by_paths(spark, views001):
    events = views001.v_plan_events
    steps = [F.col("plan_id") == S.PRO, (F.col("plan_id") == S.BASIC) & (F.year("start_date") == 1997)]
    day = F.datediff("start_date", F.lit("1970-01-01").cast("date"))
    n = P.ordered_paths(events, "customer_id", day, ["event_id"], steps, (1,)).filter("span is not null").count()
    assert n == S.downgrades_in_year(events, 1997).first()["nb_downgrades"]
