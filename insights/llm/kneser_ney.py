"""Interpolated modified Kneser-Ney probabilities from a table of n-gram counts.

An n-gram of characters is one number: 12 bits per character, the last character
lowest, so its context is ``gram >> 12`` and its shorter form drops the top 12 bits.
All tables are DataFrames keyed by such numbers, and probabilities come from joins
on them, order by order; counts grow with the corpus and are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insights.plans.sinks import materialize

BITS = 12
ORDER = 4


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order, from how many n-grams have count 1, 2, 3, 4."""
    n = counts.agg(*[F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (x or 0 for x in n)
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.1), k + 0.9) for k, x in enumerate(d))  # type: ignore[return-value]


def _discount(d: tuple[float, float, float]) -> Column:
    c = F.col("c")
    return F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _low(of: str, order: int) -> Column:
    return F.col(of).bitwiseAND((1 << (BITS * order)) - 1)


def probabilities(counts: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, p): the probability of each wanted gram's last character after the ones before.

    ``counts``: gram, c (over 0) of the training text; ``wanted``: gram, distinct."""
    tables = {order: counts.select("gram", "c")}
    asked = {order: wanted.select("gram")}
    for k in range(order - 1, 0, -1):  # below the top, counts are numbers of different characters in front
        tables[k] = materialize(tables[k + 1].groupBy(_low("gram", k).alias("gram"))
                                .agg(F.count(F.lit(1)).alias("c")), f"counts{k}")
        asked[k] = materialize(asked[k + 1].select(_low("gram", k).alias("gram")).distinct(), f"asked{k}")
    seen = tables[1].agg(F.count(F.lit(1))).first()[0]
    below = asked[1].select("gram", F.lit(1.0 / (seen + 1)).alias("p"))  # one more for characters never seen
    for k in range(1, order + 1):
        d = discounts(tables[k])
        context = F.shiftright("gram", BITS)
        of = tables[k].groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), F.sum(_discount(d)).alias("held"))
        now = asked[k].select("gram", context.alias("context"), _low("gram", k - 1).alias("less")) if k > 1 else (
            asked[k].select("gram", context.alias("context"), F.col("gram").alias("less")))
        shorter = below.select(F.col("gram").alias("less"), F.col("p").alias("shorter"))
        joined = (now.join(shorter, "less").join(of, "context", "left").join(tables[k], "gram", "left")
                  .fillna(0, ["c"]))
        p = F.when(F.col("total").isNull(), F.col("shorter")).otherwise(
            (F.col("c") - _discount(d) + F.col("held") * F.col("shorter")) / F.col("total"))
        below = materialize(joined.select("gram", p.alias("p")), f"p{k}")
    return below
