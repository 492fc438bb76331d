"""Case 1 — restaurant loyalty: spend, visits, favourite items, points.

Inputs: ``sales`` (customer_id, order_date, prod_id, txn_id, line_no),
``product`` (product_id, product_name, price), ``members`` (customer_id,
join_date).  Prices are exact decimals; a missing price counts as 0.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money
from .patterns import top_k, top_k_per_group

MENU = ["product_id", "product_name", "price"]


def _menu(product: DataFrame) -> DataFrame:
    return product.select(*MENU)


def _sales(sales: DataFrame) -> DataFrame:
    """The sales columns this case uses (the menu carries the price)."""
    return sales.select("customer_id", "order_date", "prod_id", "txn_id", "line_no")


def spend_per_customer(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Total spend per customer; sales of an unknown product count as 0.

    Sales are first counted per (customer, product) so the join to the menu
    reads one row per pair instead of one per sale.
    """
    pairs = sales.groupBy("customer_id", "prod_id").agg(F.count(F.lit(1)).alias("n"))
    j = pairs.join(_menu(product), F.col("prod_id") == F.col("product_id"), "left")
    return j.groupBy("customer_id").agg(
        money(F.sum(F.col("n") * F.coalesce(F.col("price"), F.lit(0)))).alias("total_amount"))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("number_of_dates"))


def _items_of_day(sales: DataFrame, first: Column) -> DataFrame:
    """customer_id, prod_id of each sale on the customer's first day in the order ``first``.

    The sales of a day are counted per item before the days are ranked and repeated behind it, so a busy
    day is one row per item it sold in the window and not one per sale.
    """
    counted = sales.groupBy("customer_id", "order_date", "prod_id").agg(F.count(F.lit(1)).alias("_n"))
    best = top_k_per_group(counted, "customer_id", [first], 1, ties=True)
    return best.select("customer_id", "prod_id", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("col")


def first_purchase_items(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Every item bought on the customer's first order date (one row per sale)."""
    return (_items_of_day(sales, F.col("order_date")).join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .select("customer_id", "product_name", "product_id"))


def most_purchased_item(sales: DataFrame, product: DataFrame, k: int = 1) -> DataFrame:
    counts = sales.groupBy("prod_id").agg(F.count(F.lit(1)).alias("nb_time"))
    best = top_k(counts, [F.col("nb_time").desc(), F.col("prod_id")], k)
    return (best.join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .select("product_id", "product_name", "nb_time"))


def favourite_item_per_customer(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Most bought product(s) of each customer, ties kept."""
    counts = sales.groupBy("customer_id", "prod_id").agg(F.count(F.lit(1)).alias("max_nb_time"))
    best = top_k_per_group(counts, "customer_id", [F.col("max_nb_time").desc()], 1, ties=True)
    return (best.join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .select("customer_id", "product_id", "product_name", "max_nb_time"))


def _member_sales(sales: DataFrame, members: DataFrame) -> DataFrame:
    return _sales(sales).join(members, "customer_id")


def first_item_after_join(sales: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    """First purchase on or after the join date (one row; ties broken by txn, line)."""
    ms = _member_sales(sales, members).filter(F.col("order_date") >= F.col("join_date"))
    first = top_k_per_group(ms, "customer_id", [F.col("order_date"), F.col("txn_id"), F.col("line_no"), F.col("prod_id")], 1,
                            ties=False)
    return (first.join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .select("customer_id", "product_name", "product_id"))


def last_item_before_join(sales: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    """Items of the last order date strictly before joining (ties kept)."""
    ms = _member_sales(sales, members).filter(F.col("order_date") < F.col("join_date"))
    return (_items_of_day(ms, F.col("order_date").desc()).join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .select("customer_id", "product_name", "product_id"))


def pre_join_totals(sales: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    ms = _member_sales(sales, members).filter(F.col("order_date") < F.col("join_date"))
    return (ms.join(_menu(product), F.col("prod_id") == F.col("product_id"))
            .groupBy("customer_id")
            .agg(F.count("prod_id").alias("total_item"), money(F.sum("price")).alias("total_amount")))


def loyalty_points(sales: DataFrame, product: DataFrame, bonus_ids: Sequence[int] = (1,),
                   per_unit: int = 10, multiplier: int = 2) -> DataFrame:
    """10 points per $1 spent; bonus products earn ``multiplier``×."""
    j = _sales(sales).join(_menu(product), F.col("prod_id") == F.col("product_id"))
    pts = F.when(F.col("product_id").isin(*bonus_ids), F.col("price") * (per_unit * multiplier)) \
        .otherwise(F.col("price") * per_unit)
    return j.groupBy("customer_id").agg(money(F.sum(pts)).alias("points"))


def loyalty_points_first_week(sales: DataFrame, product: DataFrame, members: DataFrame,
                              end_date: dt.date, customers: Sequence | None = None,
                              bonus_ids: Sequence[int] = (1,), per_unit: int = 10, multiplier: int = 2,
                              week_days: int = 6) -> DataFrame:
    """Points up to ``end_date``: all items double in the join week [join, join+6d]."""
    ms = _member_sales(sales, members).filter(F.col("order_date") <= F.lit(end_date))
    if customers is not None:
        ms = ms.filter(F.col("customer_id").isin(*customers))
    j = ms.join(_menu(product), F.col("prod_id") == F.col("product_id"))
    in_week = F.col("order_date").between(F.col("join_date"), F.date_add(F.col("join_date"), week_days))
    pts = (F.when(in_week | F.col("product_id").isin(*bonus_ids), F.col("price") * (per_unit * multiplier))
           .otherwise(F.col("price") * per_unit))
    return j.groupBy("customer_id").agg(money(F.sum(pts)).alias("points"))


def joined_sales_flag(sales: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    """Denormalised sales with member = 'Y' from the join date on, else 'N'."""
    j = (_sales(sales).join(_menu(product), F.col("prod_id") == F.col("product_id"))
         .join(members, "customer_id", "left"))
    flag = F.when(F.col("join_date").isNull() | (F.col("order_date") < F.col("join_date")), F.lit("N")) \
        .otherwise(F.lit("Y"))
    return j.select("customer_id", "order_date", "product_name", "price", flag.alias("member"))


def rank_by(df: DataFrame, key: Sequence[str], order: str, out: str) -> DataFrame:
    """``rank() OVER (PARTITION BY key ORDER BY order)`` without a raw-row window.

    rank = 1 + rows of the partition with a smaller ``order`` value.  Rows
    are counted per distinct (key, order) value (partial aggregation), the
    running count runs over those distinct values only, and the result is
    joined back — so a partition with a third of all rows is still spread
    over many tasks by its (key, order) pairs.
    """
    key = list(key)
    per_value = df.groupBy(*key, order).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_value.select(*key, order, (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).alias(out))
    return df.join(ranks, [*key, order])


def member_ranked_sales(sales: DataFrame, product: DataFrame, members: DataFrame) -> DataFrame:
    """Joined sales ranked by order date among a customer's sales as a member; NULL for the others.

    The rank needs dates alone, so it is taken from per-(customer, date) counts
    of the members' sales, before any menu column is joined.
    """
    known = _sales(sales).join(product.select(F.col("product_id").alias("prod_id")), "prod_id", "left_semi")
    days = known.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("__n")).join(members, "customer_id") \
        .filter(F.col("order_date") >= F.col("join_date"))
    w = Window.partitionBy("customer_id").orderBy("order_date").rowsBetween(Window.unboundedPreceding, -1)
    ranks = days.select("customer_id", "order_date", (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("int")
                        .alias("ranking"))
    return (joined_sales_flag(sales, product, members).join(ranks, ["customer_id", "order_date"], "left")
            .select("customer_id", "order_date", "product_name", "price", "member", "ranking"))
