"""Step functions: values that hold from one change to the next, without a row per key and period.

``steps`` turns signed flows into one row per key and date of change: the level from that date
on, the date of the next change, and the prefix sum of level × days before it.  From these,

* the value at a date is that of the last step not after it (``at_dates``),
* the sum over any stretch of days is a difference of two prefix sums (``at_dates`` too),
* minimum, mean and maximum over the whole span come from the steps weighted by their days,
* sums over all keys per month come from the keys that changed, and a running total of all flows
  for those that didn't.

Only the result decides how many rows there are; a dense result (``fill``) explodes each step
over its own periods, after the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def span(df: DataFrame, date: Column) -> DataFrame:
    """One row (lo, hi): the first and last date, from the dates alone."""
    return df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))


def flows(df: DataFrame, key: str, date: Column, value: Column) -> DataFrame:
    """key, d, v: net flow per key and date, rows without a date left out."""
    return df.groupBy(F.col(key).alias("key"), date.alias("d")).agg(F.sum(value).alias("v")).filter(F.col("d").isNotNull())


def steps(net: DataFrame) -> DataFrame:
    """key, d, v, level, nd (next date of change, null for the last), area (level × days before d).

    A window partition holds one key's dates of change: bounded by the calendar."""
    w = Window.partitionBy("key").orderBy("d")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    s = net.withColumn("level", F.sum("v").over(up)).withColumn("nd", F.lead("d").over(w)).withColumn("pd", F.lag("d").over(w))
    held = (F.col("level") - F.col("v")) * F.coalesce(F.datediff("d", "pd"), F.lit(0))
    return s.withColumn("area", F.sum(held).over(up)).drop("pd")


def at_dates(stepped: DataFrame, dates: DataFrame) -> DataFrame:
    """key, t, level, area: the last known level at each of ``dates`` (column t, distinct), and the sum of
    level × days up to it (exclusive); keys that have no step yet at a date have no row for it.

    The dates are one array beside each step, which keeps those until the next change."""
    every = dates.agg(F.array_sort(F.collect_set("t")).alias("__every"))  # as many as the calendar has
    mine = F.filter("__every", lambda t: (t >= F.col("d")) & (F.col("nd").isNull() | (t < F.col("nd"))))
    return (stepped.crossJoin(F.broadcast(every)).withColumn("t", F.explode(mine))
            .select("key", "t", "level", (F.col("area") + F.col("level") * F.datediff("t", "d")).alias("area")))


def fill(net: DataFrame, bounds: DataFrame, grain: str = "day") -> DataFrame:
    """key, d, level for every key and every day (or month, dates being month starts) of the
    span (``bounds``, one row); 0 before the first flow."""
    month = grain == "month"
    step = F.expr("interval 1 month") if month else F.expr("interval 1 day")
    back = (lambda c: F.add_months(c, -1)) if month else (lambda c: F.date_sub(c, 1))
    w = Window.partitionBy("key").orderBy("d")
    s = steps(net).withColumn("first", F.row_number().over(w) == 1).crossJoin(F.broadcast(bounds))
    until = F.when(F.col("nd").isNull(), F.col("hi")).otherwise(back(F.col("nd")))
    own = F.struct(F.col("level"), F.sequence(F.col("d"), until, step).alias("of"))
    none = F.lit(0).cast(s.schema["level"].dataType).alias("level")
    before = F.struct(none, F.sequence(F.col("lo"), back(F.col("d")), step).alias("of"))
    parts = F.when(F.col("first") & (F.col("d") > F.col("lo")), F.array(before, own)).otherwise(F.array(own))
    return s.select("key", F.inline(parts)).select("key", F.explode("of").alias("d"), "level")


def months(bounds: DataFrame) -> DataFrame:
    """month, lo, hi: every month of the span (a row each, as many as the calendar has)."""
    of = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month"))
    return bounds.filter(F.col("lo").isNotNull()).select(F.explode(of).alias("month"), "lo", "hi")


def carried_by_month(net: DataFrame, bounds: DataFrame) -> DataFrame:
    """month, lo, hi, carried: the sum of all keys' levels at the end of the month before (null in the first)."""
    per = net.groupBy(F.trunc("d", "month").alias("month")).agg(F.sum("v").alias("v"))
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)  # a row per month
    return months(bounds).join(per, "month", "left").select("month", "lo", "hi", F.sum(F.coalesce("v", F.lit(0))).over(before).alias("carried"))
