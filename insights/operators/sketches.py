"""Quantiles of any period from summaries stored per day.

A day's summary is at most ``points`` rows (value, weight): the values at which the day's
running count passes a multiple of 1 / ``points`` of its rows (a day of fewer rows keeps them
all).  Summaries merge by putting their rows together.  The estimated rank of any value is too
low by less than one step of each day, so by less than 1 / ``points`` of the period's rows,
however many days are merged: the error does not add up.  No randomness: reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sinks import materialize
from .selection import select_ranks

POINTS = 200


def summaries(df: DataFrame, day: str, value: str, group: Sequence[str] = (), points: int = POINTS) -> DataFrame:
    """(group …, day, value, weight, points): the stored summary of each group and day.

    ``value``: a whole number; nulls don't count, a null day or group is one of its own.  Weights are in
    1 / ``points`` rows and add up to ``points`` times the rows of the day.  Values are counted first and
    dealt over ranges of (group, day, value), so a busy day is several tasks; starts a job (the ranges are
    written down with the values)."""
    by = [*group, day]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = (df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("long").alias(value))
               .agg(F.count(F.lit(1)).alias("__c")))
    dealt = materialize(counted.repartitionByRange(ranges, *by, value).withColumn("__part", F.spark_partition_id()), "summaries")
    sums = dealt.groupBy(*by, "__part").agg(F.sum("__c").alias("__n"))
    over = Window.partitionBy(*by)  # a row per range that the day reaches into
    before = over.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__at"),
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"), F.sum("__n").over(over).alias("__rows"))
    cond = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by] + [F.col("__part") == F.col("__at")]
    inside = Window.partitionBy(*by, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    passed = [F.expr(f"({upto}) * least(__rows, {points}L) div __rows") for upto in ("__upto", "__upto - __c")]
    weight = (passed[0] - passed[1]) * F.greatest(F.col("__rows"), F.lit(points).cast("long"))
    return (dealt.withColumn("__run", F.sum("__c").over(inside)).join(sums, cond).withColumn("__upto", F.col("__run") + F.col("__off"))
            .select(*by, value, weight.alias("weight"), F.lit(points).alias("points")).filter("weight > 0"))


def merged_quantiles(stored: DataFrame, value: str, group: Sequence, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(group …, rows, names …): quantiles of the stored days put together by ``group`` (columns of ``stored``).

    The quantile of p is the least stored value whose estimated rank reaches p; its true rank differs from
    p x rows by less than rows / points, or by the rows equal to it.  All days must be stored with the same points."""
    group = list(group)
    points = stored.groupBy(*group, F.col(value).alias("v")).agg(F.sum("weight").alias("c"))
    total = stored.groupBy(*group).agg(F.sum("weight").alias("total"), F.max("points").alias("points")).filter("total > 0")
    q = F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    rank = F.greatest(F.ceil(F.col("p") * F.col("total")) - 1, F.lit(0)).cast("long")
    want = (total.select(*group, (F.col("total") / F.col("points")).cast("long").alias("rows"), "total", F.inline(q))
            .select(*group, "rows", "q", rank.alias("rank")))
    found = select_ranks(points, want.select(*group, "rank").distinct(), group)
    found = found.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("rank").alias("__rank"), "v")
    cond = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group] + [F.col("rank") == F.col("__rank")]
    return (want.join(found, cond).groupBy(*group, "rows")
            .agg(*[F.max(F.when(F.col("q") == i, F.col("v"))).alias(n) for i, n in enumerate(names)]))
