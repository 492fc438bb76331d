"""Interval join: points in time matched with windows, by equi-join on pieces of the axis.

A window is cut into whole days, sixteen days, 256 days and 4,096 days, as few pieces as cover
it (at most 30 a level, whatever its length); a point lies in one piece of each level.  So any
match shares exactly one piece: an equi-join on (level, piece), and a comparison with the exact
ends, gives each match once.  Spark sees a hash key, so it deals pieces over tasks, and a busy
piece can be split further: ``salts`` deals its points and repeats the windows that often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RADIX_BITS = 4
LEVELS = 4


def _span(low: Column, high: Column) -> Column:
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def _pieces(first: Column, last: Column) -> Column:
    """Array of (level, piece) that cover the days ``first`` … ``last``, each day once."""
    out = []
    for level in range(LEVELS):
        s = RADIX_BITS * level
        low = F.shiftright(first + ((1 << s) - 1), s)
        high = F.shiftright(last + 1, s)
        up = RADIX_BITS * (level + 1)
        low_up = F.shiftleft(F.shiftright(first + ((1 << up) - 1), up), RADIX_BITS)
        high_up = F.shiftleft(F.shiftright(last + 1, up), RADIX_BITS)
        # the part that the level above covers is left out
        both = F.concat(_span(low, low_up), _span(high_up, high))
        of = _span(low, high) if level == LEVELS - 1 else F.when(low_up < high_up, both).otherwise(_span(low, high))
        out.append(_tagged(of, level))
    return F.concat(*out)


def _tagged(pieces: Column, level: int) -> Column:
    return F.transform(pieces, lambda p: F.struct(F.lit(level).alias("level"), p.alias("piece")))


def _day(t: Column) -> Column:
    return F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")


def interval_join(points: DataFrame, windows: DataFrame, time: str, start: str, end: str, salts: int = 1) -> DataFrame:
    """Every row of ``points`` with every row of ``windows`` where ``start <= time <= end``, once.

    Column names of the two must differ.  Points without a time, windows without an end or that end
    before they start, match nothing.  Works on dates and on timestamps."""
    when = F.col(time)
    dealt = points.filter(when.isNotNull()).withColumn("__key", F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), F.shiftright(_day(when), RADIX_BITS * level).alias("piece")) for level in range(LEVELS)])))
    cut = (windows.filter(F.col(start) <= F.col(end))
           .withColumn("__of", F.explode(_pieces(_day(F.col(start)), _day(F.col(end))))))
    on = (F.col("__key.level") == F.col("__of.level")) & (F.col("__key.piece") == F.col("__of.piece"))
    if salts > 1:
        dealt = dealt.withColumn("__salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)))
        cut = cut.withColumn("__slot", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")))
        on = on & (F.col("__salt") == F.col("__slot"))
    met = dealt.join(cut, on).filter((when >= F.col(start)) & (when <= F.col(end)))
    return met.select(*points.columns, *windows.columns)
