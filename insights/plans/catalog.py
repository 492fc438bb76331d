"""Query catalog: binds each operator to the views of one data directory.

``QUERIES[key](views) -> DataFrame``.  Parameters that the source queries
hard-code (report month, event week, customer lists …) are set here to
values that exist in the driver data; the operators take them as arguments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import datetime as dt

from ..operators import balances as K
from ..operators import basket as B
from ..operators import delivery as D
from ..operators import funnel as FN
from ..operators import impact as I
from ..operators import loyalty as L
from ..operators import segments as G
from ..operators import subscription as S
from ..operators import upkeep as UK
from ..sources.views import Views
from . import report as R
from .sinks import scratch

REPORT_YEAR, REPORT_MONTH = 1997, 1

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def _reg(key: str, fn: Callable[[Views], DataFrame]) -> None:
    assert key not in QUERIES, key
    QUERIES[key] = fn


# ---- case 7 ----------------------------------------------------------------------------------
# the sales columns each key uses: only the tables behind them are read
MONEY_COLUMNS = ("qty", "price", "discount")
for _k, _f, _c in (
    ("total_quantity", B.total_quantity, ("qty",)),
    ("gross_revenue", B.gross_revenue, ("qty", "price")),
    ("total_discount", B.total_discount, MONEY_COLUMNS),
    ("unique_transactions", B.unique_transactions, ("txn_id",)),
    ("avg_unique_products_per_txn", B.avg_unique_products_per_txn, ("txn_id", "prod_id")),
    ("txn_revenue_percentiles", B.txn_revenue_percentiles, ("txn_id", *MONEY_COLUMNS)),
    ("avg_discount_per_txn", B.avg_discount_per_txn, ("txn_id", *MONEY_COLUMNS)),
    ("member_txn_split", B.member_txn_split, ("txn_id", "member")),
    ("avg_revenue_by_member", B.avg_revenue_by_member, ("txn_id", "member", *MONEY_COLUMNS)),
):
    _reg(_k, lambda v, f=_f, c=_c: f(v.sales(*c)))
PRODUCT_COLUMNS = {k: ("prod_id", *MONEY_COLUMNS) for k in R.PRODUCT_TABLES} | {
    "top_product_per_segment": ("prod_id", "qty"), "top_product_per_category": ("prod_id", "qty"),
    "product_penetration": ("prod_id", "txn_id"), "top_product_triple": ("prod_id", "txn_id"),
}
for _k, _f in R.PRODUCT_TABLES.items():
    _reg("top_products_by_revenue" if _k == "top_products" else _k,
         lambda v, f=_f, c=PRODUCT_COLUMNS[_k]: f(v.sales(*c), v.v_product))
    _reg(f"monthly_product_report_{_k}", lambda v, f=_f, c=PRODUCT_COLUMNS[_k]: f(
        R.sales_in_month(v.sales(*c, "start_txn_time"), REPORT_YEAR, REPORT_MONTH), v.v_product))
_reg("monthly_sales_report", lambda v: R.monthly_sales_report(
    v.sales(*MONEY_COLUMNS, "start_txn_time"), REPORT_YEAR, REPORT_MONTH))
_reg("monthly_txn_report", lambda v: R.monthly_txn_report(
    v.sales("txn_id", "prod_id", "member", *MONEY_COLUMNS, "start_txn_time"), REPORT_YEAR, REPORT_MONTH))
_reg("top_product_pairs", lambda v: B.top_product_sets(v.sales("prod_id", "txn_id"), v.v_product, 2, 10))
_reg("hierarchy_paths", lambda v: B.hierarchy_paths(v.v_hierarchy))
_reg("flatten_hierarchy", lambda v: B.flatten_hierarchy(v.v_hierarchy))


# ---- case 1 ----------------------------------------------------------------------------------
BONUS_IDS = (1,)
SALE = ("customer_id", "order_date", "prod_id", "txn_id", "line_no")  # the menu carries the price
POINTS_END = dt.date(1996, 1, 31)
_reg("spend_per_customer", lambda v: L.spend_per_customer(v.sales("customer_id", "prod_id"), v.v_product))
_reg("visit_days", lambda v: L.visit_days(v.sales("customer_id", "order_date")))
_reg("first_purchase_items", lambda v: L.first_purchase_items(v.sales("customer_id", "order_date", "prod_id"), v.v_product))
_reg("most_purchased_item", lambda v: L.most_purchased_item(v.sales("prod_id"), v.v_product))
_reg("favourite_item_per_customer", lambda v: L.favourite_item_per_customer(v.sales("customer_id", "prod_id"), v.v_product))
_reg("first_item_after_join", lambda v: L.first_item_after_join(v.sales(*SALE), v.v_product, v.v_members))
_reg("last_item_before_join", lambda v: L.last_item_before_join(v.sales(*SALE), v.v_product, v.v_members))
_reg("pre_join_totals", lambda v: L.pre_join_totals(v.sales(*SALE), v.v_product, v.v_members))
_reg("loyalty_points", lambda v: L.loyalty_points(v.sales(*SALE), v.v_product, BONUS_IDS))
_reg("loyalty_points_first_week",
     lambda v: L.loyalty_points_first_week(v.sales(*SALE), v.v_product, v.v_members, POINTS_END, None, BONUS_IDS))
_reg("joined_sales_flag", lambda v: L.joined_sales_flag(v.sales(*SALE), v.v_product, v.v_members))
_reg("member_ranked_sales", lambda v: L.member_ranked_sales(v.sales(*SALE), v.v_product, v.v_members))


# ---- case 2 ----------------------------------------------------------------------------------
# standard_ingredients and menu_extension read only the fixed recipe/topping
# dimensions, so they are library functions (tested in tests/) and not registered.
ITEM = ("order_id", "item_no", "pizza_id", "exclusions", "extras")
_reg("items_ordered", lambda v: D.items_ordered(v.items("pizza_id")))
_reg("unique_customers_ordering", lambda v: D.unique_customers_ordering(v.items("order_id")))
_reg("delivered_per_runner", lambda v: D.delivered_per_runner(v.v_orders_messy))
_reg("delivered_by_type", lambda v: D.delivered_by_type(v.items("order_id", "pizza_id"), v.v_orders_messy, v.v_recipes))
_reg("type_counts_per_customer", lambda v: D.type_counts_per_customer(v.v_items_messy, v.v_recipes))
_reg("largest_delivered_orders", lambda v: D.largest_delivered_orders(v.items("order_id", "pizza_id"), v.v_orders_messy))
_reg("changed_vs_unchanged_per_customer",
     lambda v: D.changed_vs_unchanged_per_customer(v.v_items_messy, v.v_orders_messy))
_reg("items_with_both_changes", lambda v: D.items_with_both_changes(v.items("order_id", "exclusions", "extras"), v.v_orders_messy))
_reg("volume_by_date_hour", lambda v: D.volume_by_date_hour(v.v_items_messy))
_reg("volume_by_weekday", lambda v: D.volume_by_weekday(v.v_items_messy))
_reg("top_extra", lambda v: D.top_extra(v.items("extras"), v.v_toppings))
_reg("top_exclusion", lambda v: D.top_exclusion(v.items("exclusions"), v.v_toppings))
_reg("order_item_label", lambda v: D.order_item_label(v.items(*ITEM), v.v_recipes, v.v_toppings))
_reg("ingredient_list_2x", lambda v: D.ingredient_list_2x(v.items(*ITEM), v.v_recipes, v.v_toppings))
_reg("ingredient_usage",
     lambda v: D.ingredient_usage(v.items(*ITEM), v.v_orders_messy, v.v_recipes, v.v_toppings))
_reg("weekly_signups", lambda v: D.weekly_signups(v.v_runners))
_reg("pickup_minutes", lambda v: D.pickup_minutes(v.v_orders_messy))
_reg("prep_time_vs_size", lambda v: D.prep_time_vs_size(v.items("order_id", "pizza_id"), v.v_orders_messy))
_reg("avg_distance_per_customer", lambda v: D.avg_distance_per_customer(v.v_orders_messy))
_reg("delivery_time_range", lambda v: D.delivery_time_range(v.v_orders_messy))
_reg("delivery_speed", lambda v: D.delivery_speed(v.v_orders_messy))
_reg("delivery_success_pct", lambda v: D.delivery_success_pct(v.v_orders_messy))
_reg("revenue_fixed_price", lambda v: D.revenue_fixed_price(v.items("order_id", "pizza_id"), v.v_orders_messy, v.v_recipes))
_reg("revenue_with_extras", lambda v: D.revenue_with_extras(v.items("order_id", "pizza_id", "extras"), v.v_orders_messy, v.v_recipes))
_reg("net_profit_after_distance",
     lambda v: D.net_profit_after_distance(v.items("order_id", "pizza_id"), v.v_orders_messy, v.v_recipes))
_reg("ratings_quality_report", lambda v: D.ratings_quality_report(v.v_ratings, v.v_orders_messy, v.t.customer))


# ---- case 3 ----------------------------------------------------------------------------------
JOURNEY_CUSTOMERS = (1, 4, 7, 10, 22, 25, 31, 40)
EVENTS_SINCE = dt.date(2000, 1, 1)
MIX_AT = dt.date(1996, 12, 31)
PLAN_YEAR = 1997
_reg("customer_journeys", lambda v: S.customer_journeys(v.v_plan_events, JOURNEY_CUSTOMERS))
_reg("total_customers", lambda v: S.total_customers(v.v_plan_events))
_reg("trials_per_month", lambda v: S.trials_per_month(v.v_plan_events))
_reg("plan_events_after", lambda v: S.plan_events_after(v.v_plan_events, EVENTS_SINCE))
_reg("churn_rate", lambda v: S.churn_rate(v.v_plan_events))
_reg("churn_after_trial", lambda v: S.churn_after_trial(v.v_plan_events))
_reg("plan_after_trial", lambda v: S.plan_after_trial(v.v_plan_events))
_reg("plan_mix_at_date", lambda v: S.plan_mix_at_date(v.v_plan_events, MIX_AT))
_reg("annual_upgrades_in_year", lambda v: S.annual_upgrades_in_year(v.v_plan_events, PLAN_YEAR))
_reg("avg_days_to_annual", lambda v: S.avg_days_to_annual(v.v_plan_events))
_reg("days_to_annual_buckets", lambda v: S.days_to_annual_buckets(v.v_plan_events))
_reg("downgrades_in_year", lambda v: S.downgrades_in_year(v.v_plan_events, PLAN_YEAR))
_reg("upgrade_paths", lambda v: S.upgrade_paths(v.v_plan_events))
_reg("monthly_recurring_revenue", lambda v: S.monthly_recurring_revenue(v.v_plan_events))
_reg("mrr_growth_rate", lambda v: S.mrr_growth_rate(v.v_plan_events))


# ---- case 4 ----------------------------------------------------------------------------------
_reg("unique_nodes", lambda v: K.unique_nodes(v.v_nodes))
_reg("nodes_per_region", lambda v: K.nodes_per_region(v.v_nodes, v.v_regions))
_reg("customers_per_region", lambda v: K.customers_per_region(v.v_nodes, v.v_regions))
_reg("avg_stay_days", lambda v: K.avg_stay_days(v.v_node_stays))
_reg("stay_percentiles_by_region", lambda v: K.stay_percentiles_by_region(v.v_node_stays, v.v_regions))
_reg("txn_type_totals", lambda v: K.txn_type_totals(v.v_txns_monthly))
_reg("avg_deposits", lambda v: K.avg_deposits(v.v_txns_monthly))
_reg("active_customers_per_month", lambda v: K.active_customers_per_month(v.v_txns_monthly))
_reg("monthly_closing_balance", lambda v: K.monthly_closing_balance(v.v_txns_monthly))
_reg("pct_balance_growth", lambda v: K.pct_balance_growth(v.v_txns_monthly))
_reg("daily_running_balance", lambda v: K.daily_running_balance(v.v_txns_daily))
_reg("monthly_balance_dense", lambda v: K.monthly_balance_dense(v.v_txns_monthly))
_reg("balance_stats", lambda v: K.balance_stats(v.v_txns_monthly))
_reg("allocation_prev_month", lambda v: K.allocation_prev_month(v.v_txns_monthly))
_reg("allocation_avg_30d", lambda v: K.allocation_avg_30d(v.v_txns_monthly))
_reg("txn_amount_percentiles", lambda v: K.txn_amount_percentiles(v.v_txns_monthly))
_reg("txn_amount_sketch", lambda v: K.txn_amount_sketch(v.v_txns_monthly))
_reg("allocation_realtime", lambda v: K.allocation_realtime(v.v_txns_monthly))


# ---- case 5 ----------------------------------------------------------------------------------
EVENT_WEEK = dt.date(1997, 6, 16)


def _clean(v):
    return I.clean_weekly_sales(v.v_weekly_raw)


_reg("clean_weekly_sales", _clean)
_reg("weekdays_used", lambda v: I.weekdays_used(_clean(v)))
_reg("missing_weeks", lambda v: I.missing_weeks(_clean(v)))
_reg("transactions_per_year", lambda v: I.transactions_per_year(_clean(v)))
_reg("sales_by_region_month", lambda v: I.sales_by_region_month(_clean(v)))
_reg("transactions_by_platform", lambda v: I.transactions_by_platform(_clean(v)))
_reg("platform_share", lambda v: I.platform_share(_clean(v)))
_reg("demographic_share_by_year", lambda v: I.demographic_share_by_year(_clean(v)))
_reg("retail_contribution", lambda v: I.retail_contribution(_clean(v)))
_reg("avg_transaction_size", lambda v: I.avg_transaction_size(_clean(v)))
_reg("before_after", lambda v: I.before_after(_clean(v), EVENT_WEEK, 4))
_reg("before_after_12w", lambda v: I.before_after(_clean(v), EVENT_WEEK, 12))
_reg("before_after_by_year", lambda v: I.before_after_by_year(_clean(v), EVENT_WEEK, 4))
_reg("hardest_hit_segments", lambda v: I.hardest_hit_segments(_clean(v), EVENT_WEEK, 12))
_reg("impact_by_dimension", lambda v: I.impact_by_dimension(_clean(v), EVENT_WEEK, 12))


# ---- case 6 ----------------------------------------------------------------------------------
def _funnel(v):
    return FN.product_funnel(v.v_clicks, v.v_pages)


def _kept_up(v, batches=3):
    """All clicks in three batches that cut through visits, purchases before and after their cart adds."""
    root = scratch(v.spark, "upkeep")
    UK.replay(root, v.v_clicks, batches, F.pmod("event_id", F.lit(batches)))
    return UK.kept_up_funnel(v.spark, root, v.v_pages)


def _visits(v):
    return FN.visit_summary(v.v_clicks, v.v_pages, v.v_users, v.v_campaigns)


_reg("total_users", lambda v: FN.total_users(v.v_users))
_reg("avg_cookies_per_user", lambda v: FN.avg_cookies_per_user(v.v_users))
_reg("visits_per_month", lambda v: FN.visits_per_month(v.v_clicks))
_reg("events_per_type", lambda v: FN.events_per_type(v.v_clicks, v.v_event_identifier))
_reg("purchase_visit_pct", lambda v: FN.purchase_visit_pct(v.v_clicks))
_reg("checkout_abandonment_pct", lambda v: FN.checkout_abandonment_pct(v.v_clicks))
_reg("top_pages", lambda v: FN.top_pages(v.v_clicks, v.v_pages))
_reg("category_views_cart", lambda v: FN.category_views_cart(v.v_clicks, v.v_pages))
_reg("top_products_purchased", lambda v: FN.top_products_purchased(v.v_clicks, v.v_pages))
_reg("product_funnel", _funnel)
_reg("category_funnel", lambda v: FN.category_funnel(_funnel(v)))
_reg("kept_up_funnel", _kept_up)
_reg("funnel_leaders", lambda v: FN.funnel_leaders(_funnel(v)))
_reg("most_abandoned_product", lambda v: FN.most_abandoned_product(_funnel(v)))
_reg("best_view_to_purchase", lambda v: FN.best_view_to_purchase(_funnel(v)))
_reg("avg_view_to_cart", lambda v: FN.avg_view_to_cart(_funnel(v)))
_reg("avg_cart_to_purchase", lambda v: FN.avg_cart_to_purchase(_funnel(v)))
_reg("visit_summary", _visits)
_reg("campaign_uplift", lambda v: FN.campaign_uplift(_visits(v)))
_reg("promotion_orders", lambda v: FN.promotion_orders(v.v_promotions, v.v_txns_monthly))
_reg("campaign_metrics", lambda v: FN.campaign_metrics(_visits(v)))


# ---- case 8 ----------------------------------------------------------------------------------
INTEREST_ID = 11
ROLLING_FROM, ROLLING_TO = dt.date(1997, 1, 1), dt.date(1997, 12, 1)


def _typed(v):
    return G.month_year_to_date(v.v_interest)


def _filtered(v):
    return G.drop_null_months(_typed(v))


def _sparse(v):
    return G.drop_null_months(G.month_year_to_date(v.v_interest_sparse))


_reg("month_year_to_date", _typed)
_reg("records_per_month", lambda v: G.records_per_month(_typed(v)))
_reg("drop_null_months", _filtered)
_reg("ids_missing_in_map", lambda v: G.ids_missing_in_map(_sparse(v), v.v_interest_map))
_reg("ids_missing_in_metrics", lambda v: G.ids_missing_in_metrics(_sparse(v), v.v_interest_map))
_reg("map_duplicate_check", lambda v: G.map_duplicate_check(v.v_interest_map))
_reg("joined_interest_rows", lambda v: G.joined_interest_rows(_filtered(v), v.v_interest_map, INTEREST_ID))
_reg("records_before_creation", lambda v: G.records_before_creation(_filtered(v), v.v_interest_map))
_reg("interests_in_all_months", lambda v: G.interests_in_all_months(_sparse(v), v.v_interest_map))
_reg("cumulative_pct_by_months", lambda v: G.cumulative_pct_by_months(_sparse(v)))
_reg("rows_removed_below_threshold", lambda v: G.rows_removed_below_threshold(_sparse(v)))
_reg("unique_interests_per_month", lambda v: G.unique_interests_per_month(_sparse(v)))
_reg("top_bottom_composition", lambda v: G.top_bottom_composition(_filtered(v), v.v_interest_map))
_reg("composition_ranks", lambda v: G.composition_ranks(_filtered(v)))
_reg("lowest_avg_ranking", lambda v: G.lowest_avg_ranking(_filtered(v), v.v_interest_map))
_reg("most_volatile_interests", lambda v: G.most_volatile_interests(_filtered(v), v.v_interest_map))
_reg("volatile_extremes", lambda v: G.volatile_extremes(_filtered(v), v.v_interest_map))
_reg("top10_avg_composition_per_month", lambda v: G.top10_avg_composition_per_month(_filtered(v), v.v_interest_map))
_reg("top10_appearances", lambda v: G.top10_appearances(_filtered(v), v.v_interest_map))
_reg("avg_of_top10_per_month", lambda v: G.avg_of_top10_per_month(_filtered(v), v.v_interest_map))
_reg("rolling_max_composition",
     lambda v: G.rolling_max_composition(_filtered(v), v.v_interest_map, ROLLING_FROM, ROLLING_TO))
_reg("qualified_interests", lambda v: G.qualified_interests(_sparse(v)))
