"""Case 4 — bank: node stays, transactions, balances and data allocation.

Inputs: ``stays`` (customer_id, region_id, node_id, start_date, end_date with
9999-12-31 = still open), ``regions`` (region_id, region_name), ``txns``
(customer_id, txn_date, txn_type deposit/purchase/withdrawal, txn_amount).

Balances are exact decimals.  They are step functions (``levels``): one row
per customer and day of change.  Only the two results that list every
customer on every day or month have rows for them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money, pct, ratio, round_double
from .levels import at_dates, carried_by_month, flows, months, span, steps
from .patterns import dense_running_total
from .selection import exact_quantiles_by
from .sketches import merged_quantiles, summaries

OPEN_END = "9999-12-31"
MICRO = 1_000_000


def signed_amount() -> Column:
    return F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))


def _round0(c: Column) -> Column:
    return F.round(c, 0).cast("decimal(18,0)")


# ---- nodes ------------------------------------------------------------------------------------
def unique_nodes(stays: DataFrame) -> DataFrame:
    return stays.agg(F.countDistinct("node_id").alias("unique_nodes"))


def nodes_per_region(stays: DataFrame, regions: DataFrame) -> DataFrame:
    per = stays.groupBy("region_id").agg(F.countDistinct("node_id").alias("nodes_per_region"))
    return per.join(regions, "region_id").select("region_id", "region_name", "nodes_per_region")


def customers_per_region(stays: DataFrame, regions: DataFrame) -> DataFrame:
    per = stays.groupBy("region_id").agg(F.countDistinct("customer_id").alias("unique_customers"))
    return per.join(regions, "region_id").select("region_id", "region_name", "unique_customers")


def _closed_stays(stays: DataFrame) -> DataFrame:
    return stays.filter((F.col("end_date") != F.lit(OPEN_END).cast("date"))
                        & (F.col("end_date") >= F.col("start_date"))) \
        .withColumn("days", F.datediff("end_date", "start_date"))


def avg_stay_days(stays: DataFrame) -> DataFrame:
    """Mean days a customer stays on a node before reallocation (open stays excluded)."""
    s = _closed_stays(stays)
    return s.agg(ratio(F.sum("days"), F.count("days"), 0).alias("avg_reallocation_days"))


def stay_percentiles_by_region(stays: DataFrame, regions: DataFrame,
                               percentiles=(0.5, 0.8, 0.95)) -> DataFrame:
    """Exact ``percentile_cont`` of stay days per region.

    Stay lengths are whole days, so the exact aggregate keeps one counter per
    distinct day count per region — bounded by the calendar, not by rows.
    """
    s = _closed_stays(stays)
    per = s.groupBy("region_id").agg(*[
        (F.round(F.percentile("days", p) * 100) / 100.0).alias(f"percentile_{int(round(p * 100))}") for p in percentiles])
    return per.join(regions, "region_id").drop("region_id")


# ---- transactions ------------------------------------------------------------------------------
def txn_type_totals(txns: DataFrame) -> DataFrame:
    return txns.groupBy("txn_type").agg(F.count(F.lit(1)).alias("unique_count"),
                                        money(F.sum("txn_amount")).alias("total_amount"))


PERCENTILES = ((0.25, "p25"), (0.5, "p50"), (0.95, "p95"))


def txn_amount_percentiles(txns: DataFrame) -> DataFrame:
    """p25/p50/p95 of the amounts of each transaction type (exact ``percentile_cont``, in cents)."""
    cents = txns.select("txn_type", (F.col("txn_amount") * 100).cast("bigint").alias("cents"))
    q = exact_quantiles_by(cents, ["txn_type"], "cents", [p for p, _ in PERCENTILES], [n for _, n in PERCENTILES])
    return q.select("txn_type", *[round_double(F.col(n) / F.lit(100.0)).alias(n) for _, n in PERCENTILES])


SUMMARY_POINTS = 50


def txn_amount_sketch(txns: DataFrame, points: int = SUMMARY_POINTS) -> DataFrame:
    """p25/p50/p95 of the amounts per transaction type and year, from summaries stored per month.

    The rank of each is wrong by less than 1 / ``points`` of the year's transactions."""
    cents = txns.select("txn_type", F.trunc("txn_date", "month").alias("month"), (F.col("txn_amount") * 100).cast("bigint").alias("cents"))
    stored = summaries(cents, "month", "cents", ["txn_type"], points).withColumn("txn_year", F.year("month"))
    q = merged_quantiles(stored, "cents", ["txn_type", "txn_year"], [p for p, _ in PERCENTILES], [n for _, n in PERCENTILES])
    return q.select("txn_type", "txn_year", F.col("rows").alias("txn_count"),
                    *[round_double(F.col(n) / F.lit(100.0)).alias(n) for _, n in PERCENTILES])


def avg_deposits(txns: DataFrame) -> DataFrame:
    """Mean over customers of their deposit count and of their mean deposit.

    Each customer's mean is kept in integer micro-units so the outer mean is
    an exact sum.
    """
    per = (txns.filter(F.col("txn_type") == "deposit").groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("n"),
                F.round(F.lit(float(MICRO)) * F.sum("txn_amount").cast("double")
                        / F.count(F.lit(1)).cast("double")).cast("bigint").alias("avg_micro")))
    return per.agg(ratio(F.sum("n"), F.count("n"), 0).alias("avg_total_deposits"),
                   ratio(F.sum("avg_micro"), F.count("avg_micro") * MICRO, 2).alias("avg_amount"))


def _monthly_flags(txns: DataFrame) -> DataFrame:
    t = F.col("txn_type")
    return txns.groupBy("customer_id", F.trunc("txn_date", "month").alias("txn_month")).agg(
        F.count_if(t == "deposit").alias("deposit_count"),
        F.count_if(t == "purchase").alias("purchase_count"),
        F.count_if(t == "withdrawal").alias("withdrawal_count"))


def active_customers_per_month(txns: DataFrame, min_deposits: int = 2) -> DataFrame:
    """Customers per month with ≥ ``min_deposits`` deposits and a purchase or withdrawal."""
    m = _monthly_flags(txns).filter((F.col("deposit_count") >= min_deposits)
                                    & ((F.col("purchase_count") >= 1) | (F.col("withdrawal_count") >= 1)))
    return m.groupBy("txn_month").agg(F.count(F.lit(1)).alias("customer_count"))


def monthly_closing_balance(txns: DataFrame) -> DataFrame:
    """Cumulative balance at the end of each month the customer was active.

    The window runs over one row per (customer, active month).
    """
    m = txns.groupBy("customer_id", F.trunc("txn_date", "month").alias("txn_month")) \
        .agg(F.sum(signed_amount()).alias("net_change"))
    w = Window.partitionBy("customer_id").orderBy("txn_month").rowsBetween(Window.unboundedPreceding, 0)
    return m.select("customer_id", "txn_month", money(F.sum("net_change").over(w)).alias("closing_balance"))


def pct_balance_growth(txns: DataFrame, growth: str = "1.05") -> DataFrame:
    """% of customers (active in ≥ 2 months) whose last closing balance exceeds
    the first by more than 5% and whose first balance is positive."""
    cb = monthly_closing_balance(txns)
    fl = cb.groupBy("customer_id").agg(
        F.min_by("closing_balance", "txn_month").alias("initial_balance"),
        F.max_by("closing_balance", "txn_month").alias("final_balance"),
        F.countDistinct("txn_month").alias("months")).filter(F.col("months") > 1)
    hit = (F.col("final_balance") > F.col("initial_balance") * F.lit(Decimal(growth))) & (F.col("initial_balance") > 0)
    return fl.agg(pct(F.count_if(hit), F.count(F.lit(1))).alias("customers_5pct"))


# ---- data allocation ------------------------------------------------------------------------------
def _net(txns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flows per customer and day, and the span of days (one row)."""
    day = F.col("txn_date").cast("date")
    return flows(txns, "customer_id", day, signed_amount()), span(txns, day)


def daily_running_balance(txns: DataFrame) -> DataFrame:
    """Balance of every customer on every day between the first and last transaction."""
    return dense_running_total(txns, "customer_id", "txn_date", signed_amount(), "day", "day", "running_balance") \
        .select("customer_id", "day", money(F.col("running_balance")).alias("running_balance"))


def monthly_balance_dense(txns: DataFrame) -> DataFrame:
    """Closing balance of every customer in every month of the data's span."""
    return dense_running_total(txns, "customer_id", "txn_date", signed_amount(), "month", "month",
                               "closing_balance") \
        .select("customer_id", "month", money(F.col("closing_balance")).alias("closing_balance"))


def balance_stats(txns: DataFrame) -> DataFrame:
    """Least, mean and greatest daily balance of every customer over the whole span.

    Each balance weighs as many days as it held; the days before a customer's first transaction hold 0."""
    net, bounds = _net(txns)
    s = steps(net).crossJoin(F.broadcast(bounds))  # one row
    days = F.datediff(F.coalesce("nd", F.date_add("hi", 1)), "d")
    per = s.groupBy("key").agg(
        F.min("level").alias("least"), F.max("level").alias("most"), F.sum(F.col("level") * days).alias("area"),
        F.max(F.datediff("hi", "lo") + 1).alias("days"), (F.min("d") > F.first("lo")).alias("late"))
    none = F.when(F.col("late"), F.lit(0))
    return per.select(F.col("key").alias("customer_id"), money(F.least("least", none)).alias("min_balance"),
                      ratio("area", "days").alias("avg_balance"), money(F.greatest("most", none)).alias("max_balance"))


def allocation_prev_month(txns: DataFrame) -> DataFrame:
    """Option 1: per month, the sum of every customer's previous month-end balance.

    That is the running total of all flows up to the month: no customer is looked at."""
    return (carried_by_month(*_net(txns)).filter(F.col("carried").isNotNull())
            .select("month", _round0(F.col("carried")).alias("total_allocation_option1")))


def allocation_avg_30d(txns: DataFrame, days: int = 30) -> DataFrame:
    """Option 2: per month, the sum over customers of their trailing ``days``-day
    mean balance on the month's last day (one value per customer-month).

    The mean is the difference of two prefix sums of balance × days, looked up at both ends of the window."""
    net, bounds = _net(txns)
    end = F.least(F.add_months("month", 1), F.date_add("hi", 1))  # the day after the window
    windows = months(bounds).select("month", end.alias("end"), F.greatest(F.date_sub(end, days), "lo").alias("begin"))
    ends = F.broadcast(windows.select("month", F.datediff("end", "begin").alias("n"), F.inline(F.array(
        F.struct(F.col("end").alias("t"), F.lit(1).alias("sign")), F.struct(F.col("begin").alias("t"), F.lit(-1).alias("sign"))))))
    found = at_dates(steps(net), ends.select("t").distinct()).join(ends, "t")  # two rows a month
    per = found.groupBy("key", "month", "n").agg(F.sum(F.col("area") * F.col("sign")).alias("s"))
    micro = F.round(F.lit(float(MICRO)) * F.col("s").cast("double") / F.col("n").cast("double")).cast("bigint")
    return per.groupBy("month").agg(ratio(F.sum(micro), F.lit(MICRO), 0).alias("total_allocation_option2"))


def allocation_realtime(txns: DataFrame) -> DataFrame:
    """Option 3: per month, the sum over customers of their maximum daily balance.

    Customers without a flow in a month hold what they held before: together that is the running total of
    all flows, less what those with a flow brought in."""
    net, bounds = _net(txns)
    begin = F.greatest(F.trunc("d", "month"), F.col("lo"))
    s = steps(net).crossJoin(F.broadcast(bounds)).withColumn("begin", begin)  # one row
    per = s.groupBy("key", F.trunc("d", "month").alias("month")).agg(
        F.max("level").alias("most"), F.min_by(F.col("level") - F.col("v"), "d").alias("brought"),
        (F.min("d") > F.first("begin")).alias("seen"))
    above = per.groupBy("month").agg(F.sum(F.greatest("most", F.when(F.col("seen"), F.col("brought"))) - F.col("brought")).alias("above"))
    total = F.coalesce("carried", F.lit(0)) + F.coalesce("above", F.lit(0))
    return carried_by_month(net, bounds).join(above, "month", "left").select("month", _round0(total).alias("total_allocation_option3"))
