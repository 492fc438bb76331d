"""Shared DataFrame patterns the case-study operators are composed of.

Scale notes that apply to all of them:

* aggregates are plain ``groupBy().agg()``: Spark combines partially on the
  map side, so a hot key costs one small partial row per task, not a hot task;
* per-group top-k uses a ranking window behind a ``rank/row_number <= k``
  filter, which Spark plans as a partial ``WindowGroupLimit`` before the
  shuffle (each task ships only its local leaders);
* totals for shares are a separate aggregate joined back (one row → broadcast
  of a proven size; per-group totals → Spark's size check picks the join), never
  an un-partitioned window over many rows;
* nothing here starts a job: every function only returns a plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct
from . import levels


def _cols(cs) -> list:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k by a total order (TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group, order: Sequence[Column], k: int = 1,
                    ties: bool = True, rank_col: str | None = None) -> DataFrame:
    """Rows ranked ``<= k`` inside each group (``ties`` keeps equal ranks)."""
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rk"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_k_with_ties(df: DataFrame, value: str, k: int, descending: bool = True) -> DataFrame:
    """All rows whose value is at least the k-th best (global rank <= k, ties kept).

    Scale form of an un-partitioned ``rank() <= k``: find the k-th value with a
    bounded top-k, then filter; no single-partition window over all rows.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    kth = df.select(value).orderBy(order).limit(k).agg(
        (F.min(value) if descending else F.max(value)).alias("__kth"))
    cond = (F.col(value) >= F.col("__kth")) if descending else (F.col(value) <= F.col("__kth"))
    return df.crossJoin(F.broadcast(kth)).filter(cond).drop("__kth")


def share_of_total(df: DataFrame, value: str, out: str, group=None, digits: int = 2) -> DataFrame:
    """Add ``out`` = 100 * value / total of value (within ``group`` if given).

    ``df`` is already aggregated.  Without groups the total is one row,
    broadcast; with groups the totals are joined back by the group, and Spark's
    own size check and skew splitting choose how.
    """
    g = _cols(group)
    totals = df.groupBy(*g).agg(F.sum(value).alias("__tot"))
    joined = df.join(totals, on=g) if g else df.crossJoin(F.broadcast(totals))
    return joined.withColumn(out, pct(F.col(value), F.col("__tot"), digits)).drop("__tot")


def calendar(df: DataFrame, date_col: str, grain: str = "day", name: str = "period") -> DataFrame:
    """Every day (or month start) between the min and max of ``date_col``.

    One aggregate row exploded with ``sequence``: its size is the length of the
    date span (days or months), independent of the number of rows.
    """
    d = F.col(date_col).cast("date")
    if grain == "month":
        lo, hi, step = F.trunc(F.min(d), "month"), F.trunc(F.max(d), "month"), F.expr("interval 1 month")
    else:
        lo, hi, step = F.min(d), F.max(d), F.expr("interval 1 day")
    return df.agg(F.explode(F.sequence(lo, hi, step)).alias(name))


def dense_running_total(df: DataFrame, key: str, date_col: str, value: Column, grain: str = "day",
                        period: str = "period", out: str = "running_total") -> DataFrame:
    """Running total of ``value`` per key over EVERY period of the data's span.

    The flows are summed per (key, period) and accumulated over the periods
    with a flow; each then covers its own periods up to the next one
    (``levels.fill``), so no key x period grid goes through a shuffle.
    """
    d = F.col(date_col).cast("date")
    at = F.trunc(d, "month") if grain == "month" else d
    return levels.fill(levels.flows(df, key, at, value), levels.span(df, at), grain).select(F.col("key").alias(key), F.col("d").alias(period), F.col("level").alias(out))


def previous_by(df: DataFrame, key: str, day: str, order: str, value: str, out: str) -> DataFrame:
    """``lag(value)`` per key over (day, order), without a window over a key's raw rows.

    The lag runs inside a (key, day); a day's first row takes the last value of
    the key's day before, from one row per (key, day).  A busy key is spread
    over its days, and the window over days is bounded by the calendar.
    """
    days = df.groupBy(key, day).agg(F.max_by(value, order).alias("__last"))
    before = days.select(key, day, F.lag("__last").over(Window.partitionBy(key).orderBy(day)).alias("__before"))
    inside = Window.partitionBy(key, day).orderBy(order)
    rows = df.withColumn("__in", F.lag(value).over(inside)).withColumn("__n", F.row_number().over(inside))
    return (rows.join(before, [key, day])
            .withColumn(out, F.when(F.col("__n") == 1, F.col("__before")).otherwise(F.col("__in")))
            .drop("__in", "__n", "__before"))
