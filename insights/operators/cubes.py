"""Iceberg cube: every combination of dimension values that carries a given share of the whole.

A group can't carry more than any coarser group it lies in.  So a value that carries too little
on its own is in no group of the answer: such values become one mark before the cube is built.  At most
1 / share values of a dimension are left, whatever the number of values in the data, and the
rows that the cube expands are as many as their combinations that occur.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iceberg_cube(df: DataFrame, dimensions: Sequence[str], support: Column, share: float,
                 measures: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per group of at least ``share`` of the total support: the dimensions as strings, ``n_fixed``
    (how many of them the group fixes), ``support`` and the measures.

    ``support``: a non-negative expression of a row, summed per group.  ``measures``: expressions of a row, summed
    per group under their names.  A dimension that a group leaves open is '(all)', a null value '(none)'.  The whole is a
    group of its own, as long as there is a row."""
    summed = {**(measures or {}), "support": support}
    sums = list(summed)
    text = [F.coalesce(F.col(d).cast("string"), F.lit("(none)")).alias(d) for d in dimensions]
    base = df.select(*text, *[c.alias(n) for n, c in summed.items()]).groupBy(*dimensions).agg(*[F.sum(n).alias(n) for n in sums])
    total = F.broadcast(base.agg((F.sum("support") * F.lit(share)).alias("__least")))  # one row
    kept = base
    for d in dimensions:
        # 1 / share rows at most
        often = (base.groupBy(F.col(d).alias("__v")).agg(F.sum("support").alias("__s")).crossJoin(total)
                 .filter("__s >= __least").select("__v"))
        kept = kept.join(F.broadcast(often), F.col(d) == F.col("__v"), "left").withColumn(d, F.col("__v")).drop("__v")
    merged = kept.groupBy(*dimensions).agg(*[F.sum(n).alias(n) for n in sums])
    open_ = [F.grouping(d).alias(f"__open_{d}") for d in dimensions]
    groups = merged.cube(*dimensions).agg(*open_, *[F.sum(n).alias(n) for n in sums])
    # null is a mark for values too rare, unless the group leaves the dimension open
    whole = reduce(lambda x, y: x & y, [F.col(d).isNotNull() | (F.col(f"__open_{d}") == 1) for d in dimensions])
    fixed = reduce(lambda x, y: x + y, [1 - F.col(f"__open_{d}") for d in dimensions])
    shown = [F.when(F.col(f"__open_{d}") == 1, "(all)").otherwise(F.col(d)).alias(d) for d in dimensions]
    return (groups.filter(whole).crossJoin(total).filter("support >= __least")
            .select(*shown, fixed.cast("int").alias("n_fixed"), *sums))
