"""Order statistics of any size of data: exact ranks, exact quantiles and full rankings.

* ``select_ranks`` — the values at given ranks, by repeated histograms: each round cuts the
  range that is left into 65,536 bins, counts them and goes on with the bin the rank lies in;
  four rounds reach one value out of 64 bits.  No sort, and the largest window has a bin a row.
* ``exact_quantiles`` / ``exact_quantiles_by`` — ``percentile_cont`` of all rows or per group.
* ``global_ranks`` — ``rank() over (order by …)``, both ways, without one window over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sinks import materialize

BITS = 16
ROUNDS = 4


def _meet(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join by the group columns (null equals null); without any, ``right`` has a few rows."""
    if not group:
        return left.crossJoin(F.broadcast(right))
    renamed = right.select(*[F.col(g).alias(f"__{g}") for g in group], *[c for c in right.columns if c not in group])
    cond = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    return left.join(renamed, cond).drop(*[f"__{g}" for g in group])


def select_ranks(counted: DataFrame, wanted: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group …, rank, v): the value at each wanted rank (from 0) of its group.

    ``counted``: group …, v (long), c (how often), one row per group and value, so a value that most
    rows share is one row.  ``wanted``: group …, rank, distinct.  The values of a group must span less
    than 2^63.  A hot group's values are dealt by value; what is joined to them is the wanted ranks."""
    low = counted.groupBy(*group).agg(F.min("v").alias("lo"))
    at = _meet(wanted, low, group).withColumn("off", F.lit(0).cast("long"))
    key = [*group, "rank", "lo", "off"]
    order = Window.partitionBy(*group, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for r in range(ROUNDS - 1, -1, -1):
        bins = (_meet(counted, at, group).withColumn("bin", F.shiftright(F.col("v") - F.col("lo"), BITS * r))
                .filter((F.col("bin") >= 0) & (F.col("bin") < 1 << BITS))
                .groupBy(*key, "bin").agg(F.sum("c").alias("n")))
        upto = bins.withColumn("upto", F.col("off") + F.sum("n").over(order))
        here = upto.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        at = here.select(*group, "rank", (F.col("lo") + F.shiftleft("bin", BITS * r)).alias("lo"),
                         (F.col("upto") - F.col("n")).alias("off"))
    return at.select(*group, "rank", F.col("lo").alias("v"))


def exact_quantiles_by(values: DataFrame, group: Sequence[str], col: str, probs: Sequence[float],
                       names: Sequence[str]) -> DataFrame:
    """Exact ``percentile_cont`` of an integer (or integer-scaled) column per group, one row per group.

    Nulls of ``col`` don't count; a group without values has no row (without groups: a row of nulls)."""
    kept = values.filter(F.col(col).isNotNull()).select(*group, F.col(col).cast("long").alias("v"))
    counted = kept.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("c"))
    q = F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    pos = ((F.col("total") - 1) * F.col("p")).alias("pos")
    want = (counted.groupBy(*group).agg(F.sum("c").alias("total")).filter("total > 0")
            .select(*group, "total", F.inline(q)).select(*group, "q", pos))
    ranks = want.select(*group, "q", "pos", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("rank"))
    found = select_ranks(counted, ranks.select(*group, "rank").distinct(), group)
    named = found.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("rank").alias("__rank"), F.col("v").cast("double").alias("x"))
    cond = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group] + [F.col("rank") == F.col("__rank")]
    per = ranks.join(named, cond).groupBy(*group, "q", "pos").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    return per.groupBy(*group).agg(*[F.max(F.when(F.col("q") == i, x)).alias(n) for i, n in enumerate(names)])


def exact_quantiles(values: DataFrame, col: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact ``percentile_cont`` of ``col`` over all rows, as one row."""
    return exact_quantiles_by(values, (), col, probs, names)


def global_ranks(df: DataFrame, value: str, ascending: str = "rank_asc", descending: str = "rank_desc",
                 dense: str | None = None) -> DataFrame:
    """``df`` with ``rank()`` over all rows by ``value``, rising and falling, ties sharing a rank.

    Values are counted, so ties are one row, and dealt over ranges; the range of a value is written
    down with it, once, and the ranges' totals (a row each) are the offsets of the running counts
    inside each range.  The counts then meet the rows by value.  Nulls rank first rising, last falling.
    ``dense``: also the dense rank rising, under that name."""
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    dealt = materialize(counted.repartitionByRange(ranges, F.col("__v").asc_nulls_first())
                        .withColumn("__part", F.spark_partition_id()), "ranks")
    sizes = dealt.groupBy("__part").agg(F.sum("__c").alias("__rows"), F.count(F.lit(1)).alias("__values"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), zero).alias("__off"),
                           F.coalesce(F.sum("__values").over(before), zero).alias("__voff"))  # a row per range
    total = sizes.agg(F.sum("__rows").alias("__total"))
    inside = Window.partitionBy("__part").orderBy(F.col("__v").asc_nulls_first())
    upto = F.sum("__c").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__off")
    ranked = (dealt.join(F.broadcast(offsets), "__part").withColumn("__upto", upto)
              .withColumn("__dense", F.row_number().over(inside) + F.col("__voff")).crossJoin(F.broadcast(total))
              .select("__v", (F.col("__upto") - F.col("__c") + 1).alias("__asc"),
                      (F.col("__total") - F.col("__upto") + 1).alias("__desc"), "__dense"))
    out = df.join(ranked, df[value].eqNullSafe(F.col("__v")))
    extra = [F.col("__dense").alias(dense)] if dense else []
    return out.select(*[df[c] for c in df.columns], F.col("__asc").alias(ascending), F.col("__desc").alias(descending), *extra)
