"""Case 3 — subscription lifecycle over plan events.

Input ``events`` (customer_id, plan_id 0 = trial … 4 = churn, plan_name,
start_date, event_id, amount).  Event order inside a customer is
(start_date, event_id): events on one date are still ordered.

"Last/first event per customer" questions are answered with ``max_by`` /
``min_by`` aggregates (partial aggregation, so one very active customer does
not become one hot task).  Questions about *adjacent* events use a global rank
(``patterns.previous_by``) or a ``row_number() <= k`` filter, which Spark
plans as a partial WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money, pct, ratio
from .paths import ordered_paths
from .patterns import previous_by, share_of_total

TRIAL, BASIC, PRO, ANNUAL, CHURN = 0, 1, 2, 3, 4
ORDER = ["start_date", "event_id"]


def _key() -> Column:
    return F.struct(*[F.col(c) for c in ORDER])


def customer_journeys(events: DataFrame, customers: Sequence[int]) -> DataFrame:
    """Plan history of the chosen customers, in event order."""
    return (events.filter(F.col("customer_id").isin(*customers))
            .select("customer_id", "plan_id", "plan_name", "start_date", F.col("amount").alias("price"))
            .orderBy("customer_id", "start_date", "plan_id"))


def total_customers(events: DataFrame) -> DataFrame:
    return events.agg(F.countDistinct("customer_id").alias("total_customers"))


def trials_per_month(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("plan_id") == TRIAL)
            .groupBy(F.trunc("start_date", "month").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("nb_trials")))


def plan_events_after(events: DataFrame, since: dt.date) -> DataFrame:
    return (events.filter(F.col("start_date") >= F.lit(since))
            .groupBy("plan_name").agg(F.count(F.lit(1)).alias("nb_events")))


def last_plan(events: DataFrame) -> DataFrame:
    """Each customer's latest plan (by start_date, event_id)."""
    return events.groupBy("customer_id").agg(F.max_by("plan_id", _key()).alias("plan_id"))


def churn_rate(events: DataFrame) -> DataFrame:
    """Customers whose latest plan is churn: count, total, % (1 decimal)."""
    lp = last_plan(events)
    churned = F.count_if(F.col("plan_id") == CHURN)
    return lp.agg(churned.alias("nb_churn"), F.count(F.lit(1)).alias("total_customers"),
                  pct(churned, F.count(F.lit(1)), 1).alias("pct_churn"))


def first_two_plans(events: DataFrame) -> DataFrame:
    """customer_id, first plan, second plan (NULL when there is none).

    ``row_number() <= 2`` becomes a partial WindowGroupLimit: every task
    keeps only two rows per customer before the shuffle.
    """
    w = Window.partitionBy("customer_id").orderBy(*ORDER)
    top2 = events.select("customer_id", "plan_id", *ORDER, F.row_number().over(w).alias("rn")) \
        .filter(F.col("rn") <= 2)
    return top2.groupBy("customer_id").agg(
        F.max(F.when(F.col("rn") == 1, F.col("plan_id"))).alias("first_plan"),
        F.max(F.when(F.col("rn") == 2, F.col("plan_id"))).alias("second_plan"))


def churn_after_trial(events: DataFrame) -> DataFrame:
    """Customers who churned straight after their initial trial; % of all customers (whole number)."""
    ft = first_two_plans(events)
    hit = F.count_if((F.col("first_plan") == TRIAL) & (F.col("second_plan") == CHURN))
    return ft.agg(hit.alias("nb_churn_after_trial"), pct(hit, F.count(F.lit(1)), 0).alias("pct_churn_after_trial"))


def plan_after_trial(events: DataFrame) -> DataFrame:
    """Plan chosen right after the initial trial: count and % (1 decimal)."""
    ft = first_two_plans(events).filter((F.col("first_plan") == TRIAL) & F.col("second_plan").isNotNull())
    counts = ft.groupBy(F.col("second_plan").alias("plan_id")).agg(F.count(F.lit(1)).alias("nb_customers"))
    return share_of_total(counts, "nb_customers", "pct_customers", digits=1)


def plan_mix_at_date(events: DataFrame, at: dt.date) -> DataFrame:
    """Plan each customer is on at ``at`` (their latest event on or before it)."""
    cur = (events.filter(F.col("start_date") <= F.lit(at))
           .groupBy("customer_id")
           .agg(F.max_by(F.struct("plan_id", "plan_name"), _key()).alias("p"))
           .select("customer_id", "p.plan_id", "p.plan_name"))
    counts = cur.groupBy("plan_id", "plan_name").agg(F.count(F.lit(1)).alias("nb_customers"))
    return share_of_total(counts, "nb_customers", "pct", digits=1)


def annual_upgrades_in_year(events: DataFrame, year: int) -> DataFrame:
    lo, hi = dt.date(year, 1, 1), dt.date(year, 12, 31)
    return (events.filter((F.col("plan_id") == ANNUAL) & F.col("start_date").between(F.lit(lo), F.lit(hi)))
            .agg(F.countDistinct("customer_id").alias("nb_annual")))


def days_to_annual(events: DataFrame) -> DataFrame:
    """customer_id, days from first event to first annual-plan event (one aggregate)."""
    per = events.groupBy("customer_id").agg(
        F.min("start_date").alias("joined"),
        F.min(F.when(F.col("plan_id") == ANNUAL, F.col("start_date"))).alias("annual"))
    return per.filter(F.col("annual").isNotNull()) \
        .select("customer_id", F.datediff("annual", "joined").alias("days"))


def avg_days_to_annual(events: DataFrame) -> DataFrame:
    d = days_to_annual(events)
    return d.agg(ratio(F.sum("days"), F.count("days"), 1).alias("avg_days_to_annual"))


# 30-day bands up to 180 days, then one open band.
BAND_WIDTH, BAND_LIMIT = 30, 180


def _band(days: Column) -> tuple[Column, Column]:
    idx = F.when(days > BAND_LIMIT, F.lit(BAND_LIMIT // BAND_WIDTH + 1)) \
        .otherwise(F.greatest(F.ceil(days / BAND_WIDTH), F.lit(1)).cast("int"))
    lo = F.when(idx == 1, F.lit(0)).otherwise((idx - 1) * BAND_WIDTH + 1)
    label = F.when(idx > BAND_LIMIT // BAND_WIDTH, F.lit(f"over {BAND_LIMIT} days")) \
        .otherwise(F.concat(lo.cast("string"), F.lit("-"), (idx * BAND_WIDTH).cast("string"), F.lit(" days")))
    return idx.cast("int"), label


def days_to_annual_buckets(events: DataFrame) -> DataFrame:
    """Customers per 30-day band of days-to-annual, with % (1 decimal) and band order."""
    d = days_to_annual(events)
    idx, label = _band(F.col("days"))
    counts = d.groupBy(idx.alias("bucket_order"), label.alias("bucket")).agg(F.count(F.lit(1)).alias("nb_customers"))
    return share_of_total(counts, "nb_customers", "pct_customers", digits=1).orderBy("bucket_order")


def downgrades_in_year(events: DataFrame, year: int, from_plan: int = PRO, to_plan: int = BASIC) -> DataFrame:
    """Customers whose ``to_plan`` event in ``year`` directly follows a ``from_plan`` event.

    "Directly follows" = the customer's event before it in (start_date, event_id)
    order (``patterns.previous_by``: no window over a customer's raw events).
    """
    moves = previous_by(events.select("customer_id", "plan_id", *ORDER), "customer_id", *ORDER, "plan_id", "from_plan")
    hits = moves.filter((F.col("from_plan") == from_plan) & (F.col("plan_id") == to_plan)
                        & F.col("start_date").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))))
    return hits.agg(F.countDistinct("customer_id").alias("nb_downgrades"))


def upgrade_paths(events: DataFrame, path: Sequence[int] = (BASIC, PRO, ANNUAL)) -> DataFrame:
    """Per customer: how many plans of ``path`` were taken in order (others may lie between), and the
    fewest days from the first to the last of them.  Customers without the first plan are left out."""
    day = F.datediff("start_date", F.lit("1970-01-01").cast("date"))
    steps = [F.col("plan_id") == p for p in path]
    taken = ordered_paths(events, "customer_id", day, ["event_id"], steps)
    return taken.filter("reached > 0").select("customer_id", F.col("reached").alias("plans_reached"), F.col("span").alias("days"))


PAID = (BASIC, PRO, ANNUAL)


def monthly_recurring_revenue(events: DataFrame, paid: Sequence[int] = PAID) -> DataFrame:
    return (events.filter(F.col("plan_id").isin(*paid))
            .groupBy(F.trunc("start_date", "month").alias("month"))
            .agg(money(F.sum("amount")).alias("mrr")))


def mrr_growth_rate(events: DataFrame, paid: Sequence[int] = PAID) -> DataFrame:
    """Month-over-month MRR growth in %.  The window runs over one row per month."""
    m = monthly_recurring_revenue(events, paid)
    prev = F.lag("mrr").over(Window.orderBy("month"))
    return (m.withColumn("prev_mrr", prev)
            .withColumn("growth_pct", pct(F.col("mrr") - F.col("prev_mrr"), F.col("prev_mrr"))))
