"""Pointer doubling against walking up the links."""

import random

import pytest

from insights.operators.hierarchy import ancestry


def brute(links):
    parent = {}
    for i, p in links:
        if i is not None:
            parent[i] = min((x for j, x in links if j == i), key=lambda x: (x is not None, x or ""))
    out = {}
    for i in parent:
        chain, at = [i], parent[i]
        while at is not None and at in parent and at not in chain:
            chain.append(at)
            at = parent[at]
        if at is None or at not in parent:
            out[i] = (chain[-1], len(chain) - 1, "ok" if at is None else "orphan", None, chain[::-1])
        else:
            out[i] = (None, None, "cycle", min(chain[chain.index(at):]), None)
    return out


def check(spark, links):
    got = ancestry(spark.createDataFrame(links, "id string, parent_id string")).collect()
    assert {r["id"]: (r["root"], r["depth"], r["status"], r["cycle"], r["path"]) for r in got} == brute(links)
    assert len(got) == len({i for i, _ in links if i is not None})


@pytest.mark.parametrize("depth", [1, 2, 7, 20])
def test_depths(spark, depth):
    chain = [(f"n{k}", f"n{k - 1}" if k else None) for k in range(depth)]
    check(spark, chain + [(f"m{k}", f"n{k % depth}") for k in range(5)])


def test_orphans_and_circles(spark):
    rng = random.Random(4)
    tree = [(f"t{k}", f"t{rng.randint(0, k - 1)}" if k else None) for k in range(60)]
    circles = [("a", "a"), ("b", "c"), ("c", "b"), *[(f"r{k}", f"r{(k + 1) % 9}") for k in range(9)], ("below", "r4"), ("deeper", "below")]
    check(spark, tree + circles + [("o", "nobody"), ("p", "o"), (None, "t1"), ("t5", "t0"), ("t5", None)])


def test_no_nodes(spark):
    check(spark, [])
