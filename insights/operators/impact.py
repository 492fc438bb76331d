"""Case 5 — weekly retail sales around an event (packaging change).

Input ``weekly_raw`` (week_date text d/m/yy, region, platform, segment text
with 'null', customer_type, transactions, sales).  ``clean_weekly_sales``
derives the typed table once; every other operator reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import dow_sunday0, parse_short_date
from ..functions.numeric import money, pct, ratio
from .cubes import iceberg_cube
from .patterns import share_of_total

# Segment code → age band (by its digit) and demographic (by its letter).
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"
DIMENSIONS = ("region", "platform", "age_band", "demographic", "customer_type")


def clean_weekly_sales(weekly_raw: DataFrame) -> DataFrame:
    d = parse_short_date("week_date", "d/M/yy")
    seg = F.when((F.col("segment") == "null") | F.col("segment").isNull(), F.lit(UNKNOWN)).otherwise(F.col("segment"))
    age = F.lit(UNKNOWN)
    for digit, band in reversed(list(AGE_BANDS.items())):
        age = F.when(F.col("segment").endswith(digit), F.lit(band)).otherwise(age)
    demo = F.lit(UNKNOWN)
    for letter, name in DEMOGRAPHICS.items():
        demo = F.when(F.col("segment").startswith(letter), F.lit(name)).otherwise(demo)
    return weekly_raw.select(
        d.alias("week_date"),
        F.weekofyear(d).alias("week_number"), F.month(d).alias("month_number"), F.year(d).alias("calendar_year"),
        "region", "platform", seg.alias("segment"), age.alias("age_band"), demo.alias("demographic"),
        "customer_type", "transactions", "sales",
        ratio(F.col("sales"), F.col("transactions")).alias("avg_transaction"))


def weekdays_used(clean: DataFrame) -> DataFrame:
    return clean.select(F.date_format("week_date", "EEEE").alias("day_of_week"),
                        dow_sunday0("week_date").alias("day_number")).distinct()


SLICE = ("calendar_year", "region", "platform", "segment", "customer_type")


def missing_weeks(clean: DataFrame, by: Sequence[str] = SLICE, weeks: int = 52) -> DataFrame:
    """Week numbers 1..``weeks`` without sales, for every slice that has any (at most 53 numbers a slice)."""
    seen = clean.groupBy(*by).agg(F.collect_set("week_number").alias("seen"))
    every = F.sequence(F.lit(1), F.lit(weeks))
    return seen.select(*by, F.explode(F.array_except(every, "seen")).alias("missing_week_number"))


def transactions_per_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy("calendar_year").agg(F.sum("transactions").cast("bigint").alias("total_transactions"))


def sales_by_region_month(clean: DataFrame) -> DataFrame:
    return clean.groupBy("region", "month_number").agg(money(F.sum("sales")).alias("total_sales"))


def transactions_by_platform(clean: DataFrame) -> DataFrame:
    return clean.groupBy("platform").agg(F.sum("transactions").cast("bigint").alias("total_transactions"))


def platform_share(clean: DataFrame, by: Sequence[str] = ("calendar_year", "month_number")) -> DataFrame:
    """% of sales per platform within each month (``by=()`` for the whole data set)."""
    g = clean.groupBy(*by, "platform").agg(money(F.sum("sales")).alias("total_sales"))
    return share_of_total(g, "total_sales", "percentage", group=list(by) or None)


def demographic_share_by_year(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("calendar_year", "demographic").agg(money(F.sum("sales")).alias("yearly_demographic_sales"))
    return share_of_total(g, "yearly_demographic_sales", "percentage_contribution", group="calendar_year")


def retail_contribution(clean: DataFrame, platform: str = "Retail") -> DataFrame:
    g = (clean.filter(F.col("platform") == platform).groupBy("age_band", "demographic")
         .agg(money(F.sum("sales")).alias("total_retail_sales")))
    return share_of_total(g, "total_retail_sales", "contribution_percentage")


def avg_transaction_size(clean: DataFrame) -> DataFrame:
    """Sales / transactions per (year, platform): a ratio of sums, not a mean of ratios."""
    return clean.groupBy("calendar_year", "platform").agg(
        money(F.sum("sales")).alias("total_sales"), F.sum("transactions").cast("bigint").alias("total_transactions"),
        ratio(F.sum("sales"), F.sum("transactions")).alias("avg_transaction_size"))


def _window_sums(event: dt.date, weeks: int) -> tuple[Column, Column]:
    lo, hi = event - dt.timedelta(weeks=weeks), event + dt.timedelta(weeks=weeks)
    w = F.col("week_date")
    before = F.sum(F.when((w >= F.lit(lo)) & (w < F.lit(event)), F.col("sales")))
    after = F.sum(F.when((w >= F.lit(event)) & (w < F.lit(hi)), F.col("sales")))
    return money(before), money(after)


def _impact(df: DataFrame, b: str = "before_sales", a: str = "after_sales",
            var: str = "sales_variance") -> DataFrame:
    return df.withColumn(var, F.col(a) - F.col(b)).withColumn("percentage_change", pct(F.col(var), F.col(b)))


def before_after(clean: DataFrame, event: dt.date, weeks: int = 4) -> DataFrame:
    """Sales in the ``weeks`` weeks before the event week vs the ``weeks`` from it on."""
    lo, hi = event - dt.timedelta(weeks=weeks), event + dt.timedelta(weeks=weeks)
    near = clean.filter((F.col("week_date") >= F.lit(lo)) & (F.col("week_date") < F.lit(hi)))
    b, a = _window_sums(event, weeks)
    return _impact(near.agg(b.alias("before_sales"), a.alias("after_sales")))


def before_after_by_year(clean: DataFrame, event: dt.date, weeks: int = 4) -> DataFrame:
    """The ``weeks`` weeks before and from the same ISO week on, for every year of the data.

    The window is one of dates, so an event early or late in the year keeps the
    weeks that lie in the year before or after.
    """
    year, day = F.col("year"), F.col("week_date")
    # Monday of the event's ISO week in that year: the week of 4 January is week 1
    start = F.date_add(F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week"), 7 * (event.isocalendar()[1] - 1))
    own = clean.select(F.col("calendar_year").alias("year")).distinct()
    near = (clean.select("week_date", "sales", F.explode(F.array(*[F.year("week_date") + k for k in (-1, 0, 1)])).alias("year"))
            .filter((day >= F.date_add(start, -7 * weeks)) & (day < F.date_add(start, 7 * weeks))))
    g = near.groupBy("year").agg(
        money(F.sum(F.when(day < start, F.col("sales")))).alias("sales_before"),
        money(F.sum(F.when(day >= start, F.col("sales")))).alias("sales_after")).join(own, "year", "left_semi")
    return _impact(g.withColumnRenamed("year", "calendar_year"), "sales_before", "sales_after", "variance")


def impact_by_dimension(clean: DataFrame, event: dt.date, weeks: int = 12,
                        dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Before/after per value of every dimension, in ONE pass.

    Rows are unpivoted with ``stack`` (one row per dimension) and aggregated
    by (dimension, value) — instead of one query per dimension.
    """
    lo, hi = event - dt.timedelta(weeks=weeks), event + dt.timedelta(weeks=weeks)
    near = clean.filter((F.col("week_date") >= F.lit(lo)) & (F.col("week_date") < F.lit(hi)))
    stacked = near.select("week_date", "sales", F.expr(
        f"stack({len(dimensions)}, "
        + ", ".join(f"'{d}', cast({d} as string)" for d in dimensions)
        + ") as (dimension, dimension_value)"))
    b, a = _window_sums(event, weeks)
    g = stacked.groupBy("dimension", "dimension_value").agg(b.alias("before_sales"), a.alias("after_sales"))
    return _impact(g, var="variance")


def hardest_hit_segments(clean: DataFrame, event: dt.date, weeks: int = 12, share: float = 0.02,
                         dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Before/after of every segment, any combination of dimension values, that made at least ``share`` of the
    sales before the event."""
    lo, hi = event - dt.timedelta(weeks=weeks), event + dt.timedelta(weeks=weeks)
    near = clean.filter((F.col("week_date") >= F.lit(lo)) & (F.col("week_date") < F.lit(hi)))
    early, none = F.col("week_date") < F.lit(event), F.lit(0).cast("decimal(18,2)")
    groups = iceberg_cube(near, dimensions, F.when(early, F.col("sales")).otherwise(none), share,
                          {"after_sales": F.when(early, none).otherwise(F.col("sales"))})
    named = groups.select(*dimensions, "n_fixed", money(F.col("support")).alias("before_sales"), money(F.col("after_sales")).alias("after_sales"))
    return _impact(named, var="variance")
