"""Most frequent combinations of any size, level by level with an exact bound.

A combination can't occur in more baskets than any part of it.  So:

1. A beam of the most frequent items is extended item by item to full combinations; the
   k-th best count among those few is a lower bound of the wanted counts.
2. Only items that occur at least that often are paired; only pairs that reach the bound
   are joined to triples, and only if all their other pairs reach it too; and so on.  A
   level's occurrences are (basket, combination) rows of combinations that reached the
   bound, so baskets of many rare items cost no more than their items.
3. With a bound of one (no combination repeats among the beam), everything that occurs
   twice is searched for, and the rest of the answer are the least combinations by id:
   each basket's first few.

A level's rows are written down before the next level reads them (``materialize``); what comes
to the driver is the bound, one number, and how many combinations reach it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sinks import materialize
from .patterns import top_k

BEAM = 16


@dataclass(frozen=True)
class Combinations:
    """``best``: p1 … pk, n.  ``bound``: the count every one of them reaches, if there are so many that
    repeat.  ``levels``: from level 2 on, how many occurrence rows (basket, items) were counted."""

    best: DataFrame
    bound: int
    levels: list[int]


def _names(n: int) -> list[str]:
    return [f"p{j}" for j in range(1, n + 1)]


def _lower_bound(bought: DataFrame, support: DataFrame, size: int, k: int, beam: int) -> int:
    """A count that the k-th best combination reaches, two at least."""
    seeds = top_k(support, [F.col("n").desc(), "i"], beam).select("i")
    held = bought.join(F.broadcast(seeds), "i").select("b", F.array("i").alias("c"))  # ``beam`` rows
    for level in range(2, size + 1):
        wider = (held.join(bought, "b").filter(~F.array_contains("c", F.col("i")))
                 .select("b", F.array_sort(F.array_append("c", F.col("i"))).alias("c")).distinct())
        if level < size:
            wider = materialize(wider, "beam")
        counts = wider.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        if level < size:
            held = wider.join(F.broadcast(top_k(counts, [F.col("n").desc(), "c"], beam).select("c")), "c")
    reached = [r["n"] for r in top_k(counts.select("n"), [F.col("n").desc()], k).collect()]  # k numbers
    return max(2, reached[-1]) if len(reached) == k else 2


def _singles(bought: DataFrame, size: int, k: int) -> DataFrame:
    """Each basket's first combinations by id: those of its first size - 1 + 2 k items."""
    first = (bought.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("i")))
             .filter(F.col("r") < size + 2 * k).groupBy("b").agg(F.array_sort(F.collect_list("i")).alias("c")))
    out = first.select("c", F.array().cast("array<int>").alias("at"))
    for _ in range(size):  # places in the basket, rising
        last = F.when(F.size("at") > 0, F.element_at("at", -1)).otherwise(F.lit(0))
        out = (out.withColumn("next", F.when(last < F.size("c"), F.sequence(last + 1, F.size("c"))))
               .select("c", "at", F.explode("next").alias("next"))
               .select("c", F.array_append("at", F.col("next")).alias("at")))
    ids = [F.element_at("c", F.element_at("at", j + 1)).alias(f"p{j + 1}") for j in range(size)]
    return out.select(*ids).distinct().withColumn("n", F.lit(1).cast("long"))


def combinations(sales: DataFrame, basket: str, item: str, size: int = 3, k: int = 1, beam: int = BEAM) -> Combinations:
    """The ``k`` most frequent sets of ``size`` (2 or more) different items of one basket (ties: smallest ids).

    Rows without basket or item are left out; an item that repeats in a basket counts once."""
    bought = materialize(sales.select(F.col(basket).alias("b"), F.col(item).alias("i")).dropna().distinct(), "bought")
    support = bought.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    bound = _lower_bound(bought, support, size, k, beam)
    held = bought.join(support.filter(F.col("n") >= bound).select("i"), "i").select("b", F.col("i").alias("p1"))
    levels, frequent, ids = [], None, _names(size)
    for level in range(2, size + 1):
        *prefix, last = _names(level - 1)
        a, b = held, held.withColumnRenamed(last, f"p{level}")
        found = a.join(b, ["b", *prefix]).filter(F.col(last) < F.col(f"p{level}"))
        if frequent is not None:  # every other part must reach the bound too
            for gone in prefix:
                rest = [p for p in _names(level) if p != gone]
                part = frequent.select(*[F.col(x).alias(y) for x, y in zip(_names(level - 1), rest, strict=True)])
                found = found.join(part, rest, "left_semi")
        found = materialize(found.select("b", *_names(level)), "found")
        levels.append(found.count())
        frequent = materialize(found.groupBy(*_names(level)).agg(F.count(F.lit(1)).alias("n"))
                               .filter(F.col("n") >= bound), "frequent")
        held = found.join(frequent.select(*_names(level)), _names(level)).select("b", *_names(level))
    every = frequent.select(*ids, "n")
    if bound == 2 and frequent.count() < k:
        every = every.unionByName(_singles(bought, size, k).join(frequent.select(*ids), ids, "left_anti"))
    return Combinations(top_k(every, [F.col("n").desc(), *ids], k), bound, levels)
