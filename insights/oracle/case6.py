"""Check SQL (DuckDB) for case 6, written from the questions."""

from .sqlfn import MONEY, PCT, RATIO, RD
from .views import with_views

VIEW, ADD, BUY, SHOWN, CLICKED = 1, 2, 3, 4, 5

# what was done with each product, and whether the visit ended in a purchase
_PRODUCTS = f"""
    WITH buyers AS (SELECT visit_id FROM v_clicks GROUP BY visit_id HAVING bool_or(event_type = {BUY})),
    steps AS (
      SELECT page_name, product_category, event_type, visit_id IN (FROM buyers) AS bought
      FROM v_pages JOIN v_clicks USING (page_id) WHERE product_id > 0),
    funnel AS (
      SELECT page_name AS product_name, product_category, count(*) FILTER (event_type = {VIEW}) AS views,
             count(*) FILTER (event_type = {ADD}) AS cart_adds,
             count(*) FILTER (event_type = {ADD} AND NOT bought) AS abandoned,
             count(*) FILTER (event_type = {ADD} AND bought) AS purchases
      FROM steps GROUP BY ALL)"""

_VISITS = f"""
    WITH seen AS (
      SELECT visit_id, user_id, event_time, event_id, event_type, page_name
      FROM v_users JOIN v_clicks USING (cookie_id) JOIN v_pages USING (page_id)),
    visits AS (
      SELECT visit_id, user_id, min(event_time) AS visit_start_time,
             count(*) FILTER (event_type = {VIEW}) AS page_views, count(*) FILTER (event_type = {ADD}) AS cart_adds,
             CAST(bool_or(event_type = {BUY}) AS INTEGER) AS purchase,
             count(*) FILTER (event_type = {SHOWN}) AS impression, count(*) FILTER (event_type = {CLICKED}) AS click,
             array_to_string(list(page_name ORDER BY event_time, event_id) FILTER (event_type = {ADD}), ', ')
                 AS cart_products
      FROM seen GROUP BY visit_id, user_id),
    told AS (
      SELECT visits.*, campaign_name
      FROM visits LEFT JOIN v_campaigns ON start_date <= visit_start_time AND end_date >= visit_start_time)"""


def _mean_rate(num: str, den: str) -> str:
    rate = f"CAST(round(100000000.0 * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)) AS BIGINT)"
    return RATIO(f"sum({rate})", f"count({rate}) * 1000000")


def _best(metric: str) -> str:
    return f"""SELECT '{metric}' AS metric, product_name, {metric} AS value FROM funnel
               QUALIFY row_number() OVER (ORDER BY {metric} DESC, product_name) = 1"""


def _highest(rate: str, name: str) -> str:
    return f"""{_PRODUCTS}
        SELECT product_name, {rate} AS {name} FROM funnel
        QUALIFY row_number() OVER (ORDER BY {rate} DESC, product_name) = 1"""


SQL = {
    "promotion_orders": f"""
        SELECT promotion_id, start_date, end_date, count(txn_date) AS txn_count,
               {MONEY('coalesce(sum(txn_amount), 0)')} AS txn_amount
        FROM v_promotions LEFT JOIN v_txns_monthly ON txn_date BETWEEN start_date AND end_date GROUP BY ALL""",
    "total_users": "SELECT count(*) AS total_users FROM (SELECT DISTINCT user_id FROM v_users)",
    "avg_cookies_per_user": f"""
        SELECT {RATIO('count(cookie_id)', 'count(DISTINCT user_id)')} AS avg_cookies_per_user FROM v_users""",
    "visits_per_month": """
        SELECT CAST(month(event_time) AS INTEGER) AS month_number, count(DISTINCT visit_id) AS total_visits FROM v_clicks GROUP BY ALL""",
    "events_per_type": """
        SELECT event_type, event_name, n AS event_count
        FROM (SELECT event_type, count(*) AS n FROM v_clicks GROUP BY ALL) JOIN v_event_identifier USING (event_type)""",
    "purchase_visit_pct": f"""
        SELECT {PCT('count(*) FILTER (bought)', 'count(*)')} AS purchase_visit_percentage
        FROM (SELECT bool_or(event_type = {BUY}) AS bought FROM v_clicks GROUP BY visit_id)""",
    "checkout_abandonment_pct": f"""
        SELECT {PCT('count(*) FILTER (NOT bought)', 'count(*)')} AS pct_checkout_abandonment
        FROM (SELECT bool_or(event_type = {BUY}) AS bought FROM v_clicks GROUP BY visit_id HAVING bool_or(page_id = 12))""",
    "top_pages": f"""
        SELECT page_name, count(*) AS total_views FROM v_pages JOIN v_clicks USING (page_id)
        WHERE event_type = {VIEW} GROUP BY page_name
        QUALIFY row_number() OVER (ORDER BY count(*) DESC, page_name) <= 3""",
    "category_views_cart": f"""
        SELECT product_category, count(*) FILTER (event_type = {VIEW}) AS total_views,
               count(*) FILTER (event_type = {ADD}) AS total_cart_adds
        FROM v_pages JOIN v_clicks USING (page_id) WHERE product_category > '' GROUP BY ALL""",
    "top_products_purchased": f"""{_PRODUCTS}
        SELECT product_name, purchases AS total_purchases FROM funnel
        QUALIFY row_number() OVER (ORDER BY purchases DESC, product_name) <= 3""",
    "product_funnel": f"{_PRODUCTS} FROM funnel",
    "kept_up_funnel": f"{_PRODUCTS} FROM funnel",
    "category_funnel": f"""{_PRODUCTS}
        SELECT product_category, {', '.join(f'CAST(sum({c}) AS BIGINT) AS total_{c}'
                                            for c in ('views', 'cart_adds', 'abandoned', 'purchases'))}
        FROM funnel GROUP BY ALL""",
    "funnel_leaders": f"{_PRODUCTS} {' UNION ALL '.join(map(_best, ('views', 'cart_adds', 'purchases')))}",
    "most_abandoned_product": _highest(PCT("abandoned", "cart_adds"), "abandonment_rate"),
    "best_view_to_purchase": _highest(PCT("purchases", "views"), "view_to_purchase_percentage"),
    "avg_view_to_cart": f"""{_PRODUCTS}
        SELECT {_mean_rate('cart_adds', 'views')} AS avg_view_to_cart_add_rate FROM funnel""",
    "avg_cart_to_purchase": f"""{_PRODUCTS}
        SELECT {_mean_rate('purchases', 'cart_adds')} AS avg_cart_add_to_purchase_rate FROM funnel""",
    "visit_summary": f"{_VISITS} FROM told",
    "campaign_uplift": f"""{_VISITS}
        SELECT ifnull(campaign_name, 'no campaign') AS campaign_name,
               if(click > 0, 'clicked', if(impression > 0, 'impression only', 'no impression')) AS ad_group,
               count(*) AS nb_visits, {PCT('count(*) FILTER (purchase = 1)', 'count(*)')} AS purchase_rate
        FROM told GROUP BY ALL""",
    "campaign_metrics": f"""{_VISITS},
        long AS (
          SELECT ifnull(campaign_name, 'no campaign') AS campaign_name, impression > 0 AS shown, metric, amount
          FROM (UNPIVOT (SELECT campaign_name, impression, CAST(page_views AS BIGINT) AS "page views",
                                CAST(cart_adds AS BIGINT) AS "cart adds", CAST(purchase AS BIGINT) AS "purchases" FROM told)
                ON "page views", "cart adds", "purchases" INTO NAME metric VALUE amount)),
        sides AS (
          SELECT campaign_name, metric, {RATIO('sum(amount) FILTER (shown)', 'count(*) FILTER (shown)', 4)} AS exposed,
                 {RATIO('sum(amount) FILTER (NOT shown)', 'count(*) FILTER (NOT shown)', 4)} AS unexposed
          FROM long GROUP BY ALL)
        SELECT *, {RD('exposed - unexposed', 4)} AS uplift FROM sides""",
}
SQL = {k: with_views(v) for k, v in SQL.items()}
