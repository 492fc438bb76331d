"""Case 6 — clickstream: digital analysis, product funnel, campaign visits.

Inputs: ``events`` (visit_id, cookie_id, page_id, event_type, event_time,
event_id, sequence_number), ``pages`` (page_id, page_name, product_category,
product_id), ``event_types`` (event_type, event_name), ``campaigns``
(campaign_id, products, campaign_name, start_date, end_date), ``users``
(user_id, cookie_id, start_date).

``pages``, ``event_types`` and ``campaigns`` are fixed literal dimensions
(a handful of rows) and are broadcast; facts are aggregated before any
join to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import money, pct, ratio, round_double
from .intervals import interval_join
from .patterns import top_k, top_k_per_group

# Event type codes and the checkout page.
PAGE_VIEW, CART_ADD, PURCHASE, IMPRESSION, AD_CLICK = 1, 2, 3, 4, 5
CHECKOUT_PAGE = 12
MICRO = 1_000_000


def _is(t: int) -> Column:
    return F.col("event_type") == t


def total_users(users: DataFrame) -> DataFrame:
    return users.agg(F.countDistinct("user_id").alias("total_users"))


def avg_cookies_per_user(users: DataFrame) -> DataFrame:
    per = users.groupBy("user_id").agg(F.count("cookie_id").alias("n"))
    return per.agg(ratio(F.sum("n"), F.count("n")).alias("avg_cookies_per_user"))


def visits_per_month(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.month("event_time").alias("month_number"))
            .agg(F.countDistinct("visit_id").alias("total_visits")))


def events_per_type(events: DataFrame, event_types: DataFrame) -> DataFrame:
    per = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    return per.join(event_types, "event_type").select("event_type", "event_name", "event_count")


def purchase_visit_pct(events: DataFrame) -> DataFrame:
    return events.agg(pct(F.countDistinct(F.when(_is(PURCHASE), F.col("visit_id"))),
                          F.countDistinct("visit_id")).alias("purchase_visit_percentage"))


def checkout_abandonment_pct(events: DataFrame, checkout_page: int = CHECKOUT_PAGE) -> DataFrame:
    """% of visits reaching checkout that end without a purchase."""
    v = events.groupBy("visit_id").agg(
        F.max((F.col("page_id") == checkout_page).cast("int")).alias("saw_checkout"),
        F.max(_is(PURCHASE).cast("int")).alias("made_purchase"))
    return v.agg(pct(F.count_if((F.col("saw_checkout") == 1) & (F.col("made_purchase") == 0)),
                     F.sum("saw_checkout")).alias("pct_checkout_abandonment"))


def top_pages(events: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    per = events.filter(_is(PAGE_VIEW)).groupBy("page_id").agg(F.count(F.lit(1)).alias("total_views"))
    named = per.join(pages.select("page_id", "page_name"), "page_id")
    return top_k(named.select("page_name", "total_views"), [F.col("total_views").desc(), F.col("page_name")], k)


def category_views_cart(events: DataFrame, pages: DataFrame) -> DataFrame:
    per = events.groupBy("page_id").agg(F.count_if(_is(PAGE_VIEW)).alias("v"), F.count_if(_is(CART_ADD)).alias("c"))
    prod = pages.filter(F.col("product_category").isNotNull()).select("page_id", "product_category")
    return (per.join(prod, "page_id").groupBy("product_category")
            .agg(F.sum("v").alias("total_views"), F.sum("c").alias("total_cart_adds")))


def purchasing_visits(events: DataFrame) -> DataFrame:
    return events.filter(_is(PURCHASE)).select("visit_id").distinct()


def top_products_purchased(events: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    """Products most added to cart within visits that end in a purchase."""
    carts = events.filter(_is(CART_ADD)).join(purchasing_visits(events), "visit_id", "left_semi")
    per = carts.groupBy("page_id").agg(F.count(F.lit(1)).alias("total_purchases"))
    prod = (pages.filter(F.col("product_id").isNotNull())
                       .select("page_id", F.col("page_name").alias("product_name")))
    return top_k(per.join(prod, "page_id").select("product_name", "total_purchases"),
                 [F.col("total_purchases").desc(), F.col("product_name")], k)


def product_funnel(events: DataFrame, pages: DataFrame) -> DataFrame:
    """views, cart_adds, abandoned (cart add in a visit without purchase), purchases per product."""
    flagged = (events.filter(_is(PAGE_VIEW) | _is(CART_ADD))
               .join(purchasing_visits(events).withColumn("bought", F.lit(True)), "visit_id", "left"))
    per = flagged.groupBy("page_id").agg(
        F.count_if(_is(PAGE_VIEW)).alias("views"),
        F.count_if(_is(CART_ADD)).alias("cart_adds"),
        F.count_if(_is(CART_ADD) & F.col("bought").isNull()).alias("abandoned"),
        F.count_if(_is(CART_ADD) & F.col("bought").isNotNull()).alias("purchases"))
    prod = (pages.filter(F.col("product_id").isNotNull())
                       .select("page_id", F.col("page_name").alias("product_name"), "product_category"))
    return per.join(prod, "page_id").select("product_name", "product_category", "views", "cart_adds",
                                            "abandoned", "purchases")


def category_funnel(funnel: DataFrame) -> DataFrame:
    return funnel.groupBy("product_category").agg(
        F.sum("views").alias("total_views"), F.sum("cart_adds").alias("total_cart_adds"),
        F.sum("abandoned").alias("total_abandoned"), F.sum("purchases").alias("total_purchases"))


def funnel_leaders(funnel: DataFrame, metrics=("views", "cart_adds", "purchases")) -> DataFrame:
    """The leading product for each funnel metric (ties broken by name)."""
    long = funnel.select("product_name", F.expr(
        f"stack({len(metrics)}, " + ", ".join(f"'{m}', {m}" for m in metrics) + ") as (metric, value)"))
    return top_k_per_group(long, "metric", [F.col("value").desc(), F.col("product_name")], 1, ties=False)


def most_abandoned_product(funnel: DataFrame) -> DataFrame:
    r = funnel.select("product_name", pct(F.col("abandoned"), F.col("cart_adds")).alias("abandonment_rate"))
    return top_k(r, [F.col("abandonment_rate").desc(), F.col("product_name")], 1)


def best_view_to_purchase(funnel: DataFrame) -> DataFrame:
    r = funnel.select("product_name", pct(F.col("purchases"), F.col("views")).alias("view_to_purchase_percentage"))
    return top_k(r, [F.col("view_to_purchase_percentage").desc(), F.col("product_name")], 1)


def _avg_rate(funnel: DataFrame, num: str, den: str, name: str) -> DataFrame:
    micro = F.round(F.lit(100.0 * MICRO) * F.col(num).cast("double")
                    / F.nullif(F.col(den).cast("double"), F.lit(0.0))).cast("bigint")
    return funnel.select(micro.alias("r")).agg(ratio(F.sum("r"), F.count("r") * MICRO).alias(name))


def avg_view_to_cart(funnel: DataFrame) -> DataFrame:
    return _avg_rate(funnel, "cart_adds", "views", "avg_view_to_cart_add_rate")


def avg_cart_to_purchase(funnel: DataFrame) -> DataFrame:
    return _avg_rate(funnel, "purchases", "cart_adds", "avg_cart_add_to_purchase_rate")


def visit_summary(events: DataFrame, pages: DataFrame, users: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per visit with counts, purchase flag, campaign and ordered cart list.

    The visit is aggregated first; its *start time* is then matched to the
    campaign window (range join against the broadcast campaign table).
    """
    names = pages.select("page_id", "page_name")
    # (event_time, event_id) is the visit's event order; sorting by it instead of the
    # per-visit row number lets Catalyst drop that window over raw events entirely
    cart_item = F.when(_is(CART_ADD), F.struct("event_time", "event_id", "page_name"))
    v = (events.join(names, "page_id")
         .groupBy("visit_id")
         .agg(F.min("cookie_id").alias("cookie_id"),
              F.min("event_time").alias("visit_start_time"),
              F.count_if(_is(PAGE_VIEW)).alias("page_views"),
              F.count_if(_is(CART_ADD)).alias("cart_adds"),
              F.max(_is(PURCHASE).cast("int")).alias("purchase"),
              F.count_if(_is(IMPRESSION)).alias("impression"),
              F.count_if(_is(AD_CLICK)).alias("click"),
              F.array_sort(F.collect_list(cart_item)).alias("cart")))
    # every cookie of a visit belongs to the same user: one representative cookie resolves it
    v = v.join(users.select("cookie_id", "user_id"), "cookie_id")
    c = campaigns.select("campaign_name", "start_date", "end_date")
    j = v.join(c, F.col("visit_start_time").between(F.col("start_date"), F.col("end_date")), "left")
    cart = F.when(F.size("cart") > 0, F.array_join(F.transform("cart", lambda x: x["page_name"]), ", "))
    return j.select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
                    "campaign_name", "impression", "click", cart.alias("cart_products"))


def campaign_uplift(summary: DataFrame) -> DataFrame:
    """Purchase rate per campaign for visits that clicked an ad, saw only an
    impression, or saw no impression."""
    group = (F.when(F.col("click") > 0, F.lit("clicked"))
             .when(F.col("impression") > 0, F.lit("impression only")).otherwise(F.lit("no impression")))
    return (summary.groupBy(F.coalesce("campaign_name", F.lit("no campaign")).alias("campaign_name"),
                            group.alias("ad_group"))
            .agg(F.count(F.lit(1)).alias("nb_visits"),
                 pct(F.sum("purchase"), F.count(F.lit(1))).alias("purchase_rate")))


# Metric of a visit → its column in the visit summary.
VISIT_METRICS = {"page views": "page_views", "cart adds": "cart_adds", "purchases": "purchase"}


def campaign_metrics(summary: DataFrame) -> DataFrame:
    """Each metric per visit with and without an ad impression, and the difference, per campaign."""
    shown = F.col("impression") > 0
    sums = [F.sum(F.when(shown if side else ~shown, F.col(c))).alias(f"{c}_{side}")
            for c in VISIT_METRICS.values() for side in (0, 1)]
    g = summary.groupBy(F.coalesce("campaign_name", F.lit("no campaign")).alias("campaign_name")).agg(
        F.count_if(shown).alias("n_1"), F.count_if(~shown).alias("n_0"), *sums)
    rows = g.select("campaign_name", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), ratio(F.col(f"{c}_1"), F.col("n_1"), 4).alias("exposed"),
                 ratio(F.col(f"{c}_0"), F.col("n_0"), 4).alias("unexposed")) for m, c in VISIT_METRICS.items()])))
    return rows.withColumn("uplift", round_double(F.col("exposed") - F.col("unexposed"), 4))


def promotion_orders(promotions: DataFrame, txns: DataFrame) -> DataFrame:
    """Transactions and money in each promotion's window; promotions overlap, and any number of them may.

    Transactions of a day are one row before they meet the windows."""
    days = txns.groupBy("txn_date").agg(F.count(F.lit(1)).alias("n"), F.sum("txn_amount").alias("amount"))
    met = interval_join(days, promotions, "txn_date", "start_date", "end_date")
    per = met.groupBy("promotion_id").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    return promotions.join(per, "promotion_id", "left").select(
        "promotion_id", "start_date", "end_date", F.coalesce("n", F.lit(0)).alias("txn_count"),
        money(F.coalesce("amount", F.lit(0))).alias("txn_amount"))
