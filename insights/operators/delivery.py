"""Case 2 — delivery operations: order metrics, ingredients, runners, pricing.

Inputs: ``orders`` (one row per order: order_id, customer_id, runner_id,
order_time, pickup_time, distance text, duration text, cancellation text),
``items`` (one row per ordered item: order_id, item_no, customer_id,
pizza_id, exclusions csv, extras csv, order_time), ``recipes`` (pizza_id,
pizza_name, toppings csv), ``toppings`` (topping_id, topping_name).

Dirty values ('null', '', NULL) are cleaned with ``functions.cleaning``.
Topping names are joined to the distinct ways a pizza was changed, not to the
items: a text is worded once, however many items carry it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import csv_int_array, is_dirty_null, number_from_text
from ..functions.numeric import money, pct, ratio
from .patterns import top_k, top_k_with_ties

UNKNOWN_TYPE = "unrecognized type"


def delivered(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled (cancellation is a dirty null)."""
    return orders.filter(is_dirty_null("cancellation"))


def _delivered_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(delivered(orders).select("order_id"), "order_id", "left_semi")


# ---- pizza metrics -------------------------------------------------------------------------
def items_ordered(items: DataFrame) -> DataFrame:
    return items.agg(F.count("pizza_id").alias("nb_pizza"))


def unique_customers_ordering(items: DataFrame, key: str = "order_id") -> DataFrame:
    """Distinct customer orders (``key='customer_id'`` counts distinct customers)."""
    return items.agg(F.countDistinct(key).alias("nb_unique"))


def delivered_per_runner(orders: DataFrame) -> DataFrame:
    return delivered(orders).groupBy("runner_id").agg(F.count("order_id").alias("nb_delivered"))


def delivered_by_type(items: DataFrame, orders: DataFrame, recipes: DataFrame) -> DataFrame:
    d = _delivered_items(items, orders).groupBy("pizza_id").agg(F.count(F.lit(1)).alias("nb_pizza_delivered"))
    names = recipes.select("pizza_id", "pizza_name")
    return (d.join(names, "pizza_id", "left")
            .select("pizza_id", F.coalesce("pizza_name", F.lit(UNKNOWN_TYPE)).alias("pizza_type"),
                    "nb_pizza_delivered"))


def type_counts_per_customer(items: DataFrame, recipes: DataFrame,
                             types: tuple[str, ...] = ("Vegetarian", "Meatlovers")) -> DataFrame:
    names = recipes.filter(F.col("pizza_name").isin(*types)).select("pizza_id", "pizza_name")
    return (items.join(names, "pizza_id").groupBy("customer_id", "pizza_name")
            .agg(F.count("pizza_id").alias("nb_pizza_ordered")))


def largest_delivered_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered orders holding the maximum number of items (ties kept)."""
    per = _delivered_items(items, orders).groupBy("order_id").agg(F.count("pizza_id").alias("nb_pizza_delivered"))
    return top_k_with_ties(per, "nb_pizza_delivered", 1)


def _changed(items_df: DataFrame) -> Column:
    return ~(is_dirty_null("exclusions") & is_dirty_null("extras"))


def changed_vs_unchanged_per_customer(items: DataFrame, orders: DataFrame) -> DataFrame:
    d = _delivered_items(items, orders)
    ch = _changed(d)
    return d.groupBy("customer_id").agg(F.count_if(~ch).alias("nb_pizza_delivered_not_change"),
                                        F.count_if(ch).alias("nb_pizza_delivered_change"))


def items_with_both_changes(items: DataFrame, orders: DataFrame) -> DataFrame:
    d = _delivered_items(items, orders)
    both = ~is_dirty_null("exclusions") & ~is_dirty_null("extras")
    return d.agg(F.count_if(both).alias("nb_pizza_delivered_change"))


def volume_by_date_hour(items: DataFrame) -> DataFrame:
    return (items.groupBy(F.col("order_time").cast("date").alias("order_date"),
                          F.hour("order_time").cast("int").alias("order_hour"))
            .agg(F.count("pizza_id").alias("nb_pizza_ordered")))


def volume_by_weekday(items: DataFrame) -> DataFrame:
    """Items per (month name, ISO week, weekday name); names are not blank-padded."""
    return (items.groupBy(F.date_format("order_time", "MMMM").alias("order_month"),
                          F.weekofyear("order_time").cast("int").alias("order_week"),
                          F.date_format("order_time", "EEEE").alias("day_of_week"))
            .agg(F.count("pizza_id").alias("nb_pizza_ordered")))


# ---- ingredients ----------------------------------------------------------------------------
def standard_ingredients(recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Each recipe's topping list as alphabetically ordered names."""
    key = ["pizza_id", "pizza_name", "toppings"]
    listed = recipes.select(*key, F.explode_outer(csv_int_array("toppings")).alias("topping_id"))
    return _joined_names(listed, F.col("topping_name"), toppings, "standard_ingredients", key)


def _top_topping(items: DataFrame, toppings: DataFrame, column: str, k: int = 1) -> DataFrame:
    ids = items.select(F.explode(csv_int_array(column)).alias("topping_id"))
    counts = ids.groupBy("topping_id").agg(F.count(F.lit(1)).alias("nb_time_added"))
    named = counts.join(toppings, "topping_id")
    return top_k(named, [F.col("nb_time_added").desc(), F.col("topping_id")], k)


def top_extra(items: DataFrame, toppings: DataFrame, k: int = 1) -> DataFrame:
    return _top_topping(items, toppings, "extras", k)


def top_exclusion(items: DataFrame, toppings: DataFrame, k: int = 1) -> DataFrame:
    return _top_topping(items, toppings, "exclusions", k)


def _form(column: str) -> Column:
    """A csv cell as a key: all its ways of being empty are one."""
    return F.when(is_dirty_null(column), F.lit("")).otherwise(F.col(column))


FORM = ["pizza_id", "_excl", "_extra"]


def _labelled(items: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """order_id, item_no, text of every item; ``texts`` words each distinct (pizza, exclusions, extras) once.

    The forms are as many as there are ways to change a pizza, however many items were ordered; the join
    that brings their texts back is left to Spark's size check and skew splitting.
    """
    keyed = items.select("order_id", "item_no", "pizza_id", _form("exclusions").alias("_excl"),
                         _form("extras").alias("_extra"))
    return keyed.join(texts(keyed.select(*FORM).distinct()), FORM).select("order_id", "item_no", "text")


def _joined_names(listed: DataFrame, shown: Column, toppings: DataFrame, out: str, key: Sequence[str] = FORM) -> DataFrame:
    """``key`` and ``out``: the listed ``topping_id`` (may be NULL) as names in their order, unknown ids skipped."""
    named = listed.join(toppings.select("topping_id", "topping_name"), "topping_id", "left")
    entry = F.when(F.col("topping_name").isNotNull(), F.struct("topping_name", shown.alias("shown")))
    return named.groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("_names")) \
        .select(*key, F.array_join(F.col("_names.shown"), ", ").alias(out))


def order_item_label(items: DataFrame, recipes: DataFrame, toppings: DataFrame,
                     pizza_name: str | None = "Meatlovers") -> DataFrame:
    """'Name - Exclude a, b - Extra c' for every item (of one pizza type if given)."""
    names = recipes.select("pizza_id", "pizza_name")
    if pizza_name is not None:
        names = names.filter(F.col("pizza_name") == pizza_name)

    def texts(forms: DataFrame) -> DataFrame:
        known = forms.join(names, "pizza_id")
        lists = {}
        for c in ("_excl", "_extra"):
            ids = known.select(*FORM, F.explode(csv_int_array(c)).alias("topping_id"))
            lists[c] = _joined_names(ids, F.col("topping_name"), toppings, c + "_names")
        full = known.join(lists["_excl"], FORM, "left").join(lists["_extra"], FORM, "left")
        part = lambda label, c: F.coalesce(F.concat(F.lit(label), F.col(c)), F.lit(""))
        return full.select(*FORM, F.concat(F.col("pizza_name"), part(" - Exclude ", "_excl_names"),
                                           part(" - Extra ", "_extra_names")).alias("text"))

    # the type is looked up before the items move: only its own are labelled
    wanted = items.join(names.select("pizza_id"), "pizza_id", "left_semi")
    return _labelled(wanted, texts).withColumnRenamed("text", "order_item")


def _parsed(df: DataFrame, **lists: str) -> DataFrame:
    """Parse each csv column ONCE into an ``array<int>`` column.

    Later per-element lambdas refer to these columns; building the arrays
    inline inside a lambda would re-parse the text for every element.
    """
    return df.select("*", *[csv_int_array(src).alias(name) for name, src in lists.items()])


def ingredient_list_2x(items: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """'Name: a, 2xb, c' per item: (recipe − exclusions) ∪ extras, sorted by name;
    '2x' marks an extra that is also still in the recipe."""
    def texts(forms: DataFrame) -> DataFrame:
        known = recipes.select("pizza_id", "pizza_name", csv_int_array("toppings").alias("base_ids"))
        lists = _parsed(forms.join(known, "pizza_id"), excl_ids="_excl", extra_ids="_extra") \
            .withColumn("kept_ids", F.array_except("base_ids", "excl_ids"))
        ids = lists.select(*FORM, F.array_intersect("kept_ids", "extra_ids").alias("twice"),
                           F.explode_outer(F.array_union("kept_ids", "extra_ids")).alias("topping_id"))
        shown = F.when(F.array_contains("twice", F.col("topping_id")), F.concat(F.lit("2x"), F.col("topping_name"))) \
            .otherwise(F.col("topping_name"))
        worded = _joined_names(ids, shown, toppings, "_list")
        return worded.join(recipes.select("pizza_id", "pizza_name"), "pizza_id") \
            .select(*FORM, F.concat(F.col("pizza_name"), F.lit(": "), F.col("_list")).alias("text"))

    return _labelled(items, texts).withColumnRenamed("text", "ingredient_list")


def ingredient_usage(items: DataFrame, orders: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """Quantity of each ingredient over delivered items: (recipe − exclusions) + extras."""
    d = _parsed(_delivered_items(items, orders).join(_parsed(recipes, base_ids="toppings"), "pizza_id"),
                excl_ids="exclusions", extra_ids="extras")
    used = F.concat(F.array_except("base_ids", "excl_ids"), F.col("extra_ids"))
    counts = d.select(F.explode(used).alias("topping_id")).groupBy("topping_id") \
        .agg(F.count(F.lit(1)).alias("total_used"))
    return counts.join(toppings, "topping_id").select("topping_name", "total_used")


# ---- runners and customers ---------------------------------------------------------------------
def weekly_signups(runners: DataFrame) -> DataFrame:
    """Runners registered per week (weeks start on Monday)."""
    return (runners.groupBy(F.trunc("registration_date", "week").alias("registration_week"))
            .agg(F.count("runner_id").alias("nb_runner")))


def pickup_minutes(orders: DataFrame, by: str = "runner_id") -> DataFrame:
    """Mean minutes from order to pickup over delivered orders, per runner."""
    d = delivered(orders).filter(F.col("pickup_time").isNotNull())
    secs = F.timestamp_diff("SECOND", F.col("order_time"), F.col("pickup_time"))
    return d.groupBy(by).agg(ratio(F.sum(secs), F.count(secs) * 60).alias("avg_minutes_to_pickup"))


def _duration(orders: DataFrame) -> Column:
    return number_from_text("duration", 10, 0).cast("int")


def prep_time_vs_size(items: DataFrame, orders: DataFrame) -> DataFrame:
    per = items.groupBy("order_id").agg(F.count("pizza_id").alias("nb_pizza"))
    d = delivered(orders).select("order_id", _duration(orders).alias("duration_minutes"))
    return per.join(d, "order_id").select("order_id", "nb_pizza", "duration_minutes")


def avg_distance_per_customer(orders: DataFrame) -> DataFrame:
    """Mean km per delivered order, per customer ('23.4 km' → 23.4)."""
    d = delivered(orders).select("customer_id", number_from_text("distance", 10, 1).alias("km"))
    return d.groupBy("customer_id").agg(ratio(F.sum("km"), F.count("km")).alias("avg_distance"))


def delivery_time_range(orders: DataFrame) -> DataFrame:
    dur = _duration(orders)
    return delivered(orders).agg((F.max(dur) - F.min(dur)).alias("delivery_time_range"))


def delivery_speed(orders: DataFrame) -> DataFrame:
    d = delivered(orders)
    return d.select("runner_id", "order_id",
                    ratio(number_from_text("distance", 10, 1), _duration(orders), 4)
                    .alias("avg_speed_km_per_minute"))


def delivery_success_pct(orders: DataFrame) -> DataFrame:
    """Share of each runner's orders that were delivered (runners with 0 kept)."""
    return orders.groupBy("runner_id").agg(
        pct(F.count_if(is_dirty_null("cancellation")), F.count(F.lit(1))).alias("success_rate"))


# ---- pricing ------------------------------------------------------------------------------------
# Menu prices in dollars.
PRICES = {"Meatlovers": 12, "Vegetarian": 10}


def _price_table(spark, prices: Mapping[str, int]) -> DataFrame:
    from ..sources.views import literal_table
    return literal_table(spark, list(prices.items()), "pizza_name string, pizza_price int")


def _priced_delivered(items, orders, recipes, prices):
    d = _delivered_items(items, orders).join(recipes.select("pizza_id", "pizza_name"), "pizza_id")
    return d.join(_price_table(items.sparkSession, prices), "pizza_name")


def revenue_fixed_price(items: DataFrame, orders: DataFrame, recipes: DataFrame,
                        prices: Mapping[str, int] = PRICES) -> DataFrame:
    d = _priced_delivered(items, orders, recipes, prices)
    return d.agg(F.sum("pizza_price").cast("bigint").alias("total_revenue"))


def revenue_with_extras(items: DataFrame, orders: DataFrame, recipes: DataFrame,
                        prices: Mapping[str, int] = PRICES, extra_charge: int = 1) -> DataFrame:
    d = _priced_delivered(items, orders, recipes, prices)
    return d.agg(F.sum(F.col("pizza_price") + F.size(csv_int_array("extras")) * extra_charge)
                 .cast("bigint").alias("total_revenue"))


def net_profit_after_distance(items: DataFrame, orders: DataFrame, recipes: DataFrame,
                              prices: Mapping[str, int] = PRICES, rate_per_km: str = "0.30") -> DataFrame:
    """Revenue of delivered items minus runner pay per km, each order's km once."""
    rev = (_priced_delivered(items, orders, recipes, prices)
           .groupBy("order_id").agg(F.sum("pizza_price").alias("rev")))
    km = delivered(orders).select("order_id", number_from_text("distance", 10, 1).alias("km"))
    per_order = rev.join(km, "order_id")
    return per_order.agg(money(F.sum("rev") - F.sum(F.col("km") * F.lit(Decimal(rate_per_km))))
                         .alias("net_profit"))


def menu_extension(recipes: DataFrame, toppings: DataFrame, pizza_id: int, pizza_name: str) -> DataFrame:
    """The menu plus a new pizza made of every topping."""
    new = toppings.agg(F.array_join(F.array_sort(F.collect_list("topping_id")), ", ").alias("toppings")) \
        .select(F.lit(pizza_id).cast("int").alias("pizza_id"), F.lit(pizza_name).alias("pizza_name"), "toppings")
    return recipes.unionByName(new)


# ---- ratings data quality -----------------------------------------------------------------------
def ratings_quality_report(ratings: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Violations of the ratings table's declared rules, one row per rule.

    NOT NULL per column, UNIQUE order_id, CHECK rating in 1..5 — one
    aggregate pass — plus the two foreign keys as anti-joins.
    """
    counts = ratings.agg(
        F.count_if(F.col("order_id").isNull()).alias("order_id NOT NULL"),
        F.count_if(F.col("runner_id").isNull()).alias("runner_id NOT NULL"),
        F.count_if(F.col("customer_id").isNull()).alias("customer_id NOT NULL"),
        F.count_if(F.col("rating").isNull()).alias("rating NOT NULL"),
        (F.count("order_id") - F.countDistinct("order_id")).alias("order_id UNIQUE"),
        F.count_if(~F.col("rating").between(1, 5)).alias("rating CHECK 1-5"))
    rules = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").cast("bigint").alias("violations"))
        for c in counts.columns])).alias("r")).select("r.*")
    fk_order = (ratings.filter(F.col("order_id").isNotNull())
                .join(orders.select("order_id"), "order_id", "left_anti")
                .agg(F.lit("order_id FOREIGN KEY").alias("rule"), F.count(F.lit(1)).alias("violations")))
    fk_cust = (ratings.filter(F.col("customer_id").isNotNull())
               .join(customers.select(F.col("c_custkey").alias("customer_id")), "customer_id", "left_anti")
               .agg(F.lit("customer_id FOREIGN KEY").alias("rule"), F.count(F.lit(1)).alias("violations")))
    return rules.unionByName(fk_order).unionByName(fk_cust)
