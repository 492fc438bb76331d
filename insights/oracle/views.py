"""DuckDB SQL twins of ``insights.sources.views`` for the correctness oracle.

The driver registers only the raw tables, so each oracle query carries the
views it needs as CTEs: ``with_views(sql, "v_sales", "v_product")`` prefixes
the definitions (and the views they depend on) to the query text.
"""

from __future__ import annotations

import re

MONEY = "DECIMAL(12,2)"

_ORDER_TIME = "(o_orderdate + to_minutes(CAST((o_orderkey * 37) % 1440 AS BIGINT)))"

VIEW_SQL: dict[str, str] = {
    "v_sales": f"""
        SELECT l_orderkey AS txn_id, l_linenumber AS line_no, o_custkey AS customer_id,
               l_partkey AS prod_id, CAST(l_quantity AS INTEGER) AS qty,
               CAST(p_retailprice AS {MONEY}) AS price,
               CAST(round(l_discount * 100) AS INTEGER) AS discount,
               CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS start_txn_time,
               c_mktsegment = 'BUILDING' AS member
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""",
    "v_product": f"""
        SELECT p_partkey AS product_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
               p_type AS segment_name, p_brand AS category_name,
               p_type || '-' || CAST(CAST(floor(p_size / 10) AS BIGINT) AS VARCHAR) AS bucket,
               CAST(p_retailprice AS {MONEY}) AS price
        FROM part""",
    "v_members": """
        SELECT c_custkey AS customer_id, min(CAST(o_orderdate AS DATE)) AS join_date
        FROM customer JOIN orders ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'
        GROUP BY c_custkey""",
    "v_orders_messy": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 7 + 1 AS runner_id,
               {_ORDER_TIME} AS order_time,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE {_ORDER_TIME} + to_minutes(CAST(o_orderkey % 40 + 5 AS BIGINT)) END AS pickup_time,
               CASE WHEN o_orderstatus = 'P' THEN 'null'
                    ELSE CAST(CAST(round(o_totalprice / 1000) AS BIGINT) // 10 AS VARCHAR) || '.'
                         || CAST(CAST(round(o_totalprice / 1000) AS BIGINT) % 10 AS VARCHAR)
                         || CASE WHEN o_orderkey % 2 = 0 THEN 'km' ELSE ' km' END END AS distance,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE CAST(o_orderkey % 35 + 10 AS VARCHAR)
                         || CASE WHEN o_orderkey % 2 = 0 THEN ' minutes' ELSE 'mins' END END AS duration,
               CASE WHEN o_orderstatus = 'P' THEN 'Customer Cancellation'
                    WHEN o_orderkey % 3 = 0 THEN 'null' WHEN o_orderkey % 3 = 1 THEN '' END AS cancellation
        FROM orders""",
    "v_items_messy": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS item_no, o_custkey AS customer_id,
               CAST(l_partkey % 3 + 1 AS INTEGER) AS pizza_id,
               CASE l_partkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN ''
                    WHEN 2 THEN CAST(l_partkey % 12 + 1 AS VARCHAR) || ', ' || CAST((l_partkey + 5) % 12 + 1 AS VARCHAR)
               END AS exclusions,
               CASE l_suppkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN CAST(l_suppkey % 12 + 1 AS VARCHAR)
               END AS extras,
               {_ORDER_TIME} AS order_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_recipes": """
        SELECT * FROM (VALUES (1, 'Meatlovers', '1, 2, 3, 4, 5, 6, 8, 10'),
                              (2, 'Vegetarian', '4, 6, 7, 9, 11, 12'),
                              (3, 'Supreme', '1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12'))
               AS t(pizza_id, pizza_name, toppings)""",
    "v_toppings": """
        SELECT * FROM (VALUES (1, 'Anchovies'), (2, 'Basil'), (3, 'Beef'), (4, 'Cheese'), (5, 'Chicken'),
                              (6, 'Garlic'), (7, 'Ham'), (8, 'Mushrooms'), (9, 'Olives'), (10, 'Onions'),
                              (11, 'Peppers'), (12, 'Tomato Sauce')) AS t(topping_id, topping_name)""",
    "v_runners": """
        SELECT o_custkey AS runner_id, min(CAST(o_orderdate AS DATE)) AS registration_date
        FROM orders GROUP BY o_custkey""",
    "v_ratings": """
        SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
               o_orderkey % 7 + 1 AS runner_id, o_custkey AS customer_id,
               CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey % 6 END AS INTEGER) AS rating
        FROM orders""",
    "v_plan_events": f"""
        SELECT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
               substr(o_orderpriority, 3) AS plan_name, CAST(o_orderdate AS DATE) AS start_date,
               o_orderkey AS event_id, CAST(o_totalprice AS {MONEY}) AS amount
        FROM orders""",
    "v_node_stays": """
        SELECT o_custkey AS customer_id, n_regionkey AS region_id, o_orderkey % 5 + 1 AS node_id,
               CAST(o_orderdate AS DATE) AS start_date,
               coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                        DATE '9999-12-31') AS end_date
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_regions": "SELECT r_regionkey AS region_id, r_name AS region_name FROM region",
    "v_txns_daily": f"""
        SELECT user_id AS customer_id, CAST(ts AS DATE) AS txn_date,
               CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'purchase' THEN 'purchase'
                    ELSE 'withdrawal' END AS txn_type,
               CAST(value AS {MONEY}) AS txn_amount
        FROM events WHERE event_type IN ('signup', 'purchase', 'click')""",
    "v_txns_monthly": f"""
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
               CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'purchase' ELSE 'withdrawal' END AS txn_type,
               CAST(o_totalprice AS {MONEY}) AS txn_amount
        FROM orders""",
    "v_weekly_raw": f"""
        SELECT strftime(date_trunc('week', CAST(o_orderdate AS DATE)), '%-d/%-m/%y') AS week_date,
               r_name AS region,
               CASE WHEN o_orderpriority < '3' THEN 'Shopify' ELSE 'Retail' END AS platform,
               (['C1', 'C2', 'C3', 'F1', 'F4', 'null'])[CAST(o_custkey % 6 + 1 AS INTEGER)] AS segment,
               c_mktsegment AS customer_type,
               CAST(count(*) AS INTEGER) AS transactions,
               CAST(sum(CAST(o_totalprice AS {MONEY})) AS DECIMAL(18,2)) AS sales
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3, 4, 5""",
    "v_clicks": """
        SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS visit_id,
               CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS cookie_id,
               CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 13 + 1 AS page_id,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                    WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS event_type,
               ts AS event_time, event_id,
               row_number() OVER (PARTITION BY CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)
                                  ORDER BY ts, event_id) AS sequence_number
        FROM events""",
    "v_users": """
        SELECT user_id, CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 3 AS VARCHAR) AS cookie_id,
               min(ts) AS start_date
        FROM events GROUP BY 1, 2""",
    "v_pages": """
        SELECT * FROM (VALUES (1, 'Home Page', NULL, NULL), (2, 'All Products', NULL, NULL),
                              (3, 'Cod', 'Fish', 1), (4, 'Mackerel', 'Fish', 2), (5, 'Sardine', 'Fish', 3),
                              (6, 'Caviar', 'Luxury', 4), (7, 'Truffle', 'Luxury', 5),
                              (8, 'Clam', 'Shellfish', 6), (9, 'Crab', 'Shellfish', 7), (10, 'Mussel', 'Shellfish', 8),
                              (11, 'Shrimp', 'Shellfish', 9), (12, 'Checkout', NULL, NULL),
                              (13, 'Confirmation', NULL, NULL))
               AS t(page_id, page_name, product_category, product_id)""",
    "v_event_identifier": """
        SELECT * FROM (VALUES (1, 'Page View'), (2, 'Add to Cart'), (3, 'Purchase'), (4, 'Ad Impression'),
                              (5, 'Ad Click')) AS t(event_type, event_name)""",
    "v_promotions": """
        SELECT s_suppkey AS promotion_id, DATE '1992-01-01' + CAST(s_suppkey * 37 % 2400 AS INTEGER) AS start_date,
               DATE '1992-01-01' + CAST(s_suppkey * 37 % 2400 + s_suppkey * 11 % 61 AS INTEGER) AS end_date
        FROM supplier""",
    "v_campaigns": """
        SELECT campaign_id, products, campaign_name, CAST(s AS TIMESTAMP) AS start_date, CAST(e AS TIMESTAMP) AS end_date
        FROM (VALUES (1, '1-3', 'Spring Catch', '2024-01-01 00:00:00', '2024-01-08 00:00:00'),
                     (2, '4-5', 'Luxury Week', '2024-01-10 00:00:00', '2024-01-18 00:00:00'),
                     (3, '6-9', 'Shellfish Days', '2024-01-20 00:00:00', '2024-01-30 00:00:00'))
             AS t(campaign_id, products, campaign_name, s, e)""",
    "v_hierarchy": f"""
        SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent_id,
               'Region' AS level_name, r_name AS level_text, CAST(NULL AS {MONEY}) AS price FROM region
        UNION ALL
        SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), 'Nation', n_name,
               CAST(NULL AS {MONEY}) FROM nation
        UNION ALL
        SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'N' || CAST(s_nationkey AS VARCHAR), 'Supplier', s_name,
               CAST(s_acctbal AS {MONEY}) FROM supplier""",
    "v_interest_map": """
        SELECT id, 'Interest ' || CAST(id AS VARCHAR) AS interest_name,
               'Summary of interest ' || CAST(id AS VARCHAR) AS interest_summary,
               TIMESTAMP '1996-06-15 00:00:00' AS created_at, TIMESTAMP '1996-06-15 00:00:00' AS last_modified
        FROM (SELECT DISTINCT CAST(CAST(substr(p_brand, 7) AS INTEGER) * 10 + p_size % 6 AS INTEGER) AS id FROM part
              WHERE (CAST(substr(p_brand, 7) AS INTEGER) * 10 + p_size % 6) % 17 <> 0
              UNION ALL SELECT CAST(least(range, 9005) AS INTEGER) FROM range(9001, 9008))""",
}


def _interest(keep: str) -> str:
    return f"""
        WITH sold_by_month AS (
          SELECT CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS month,
                 CAST(substr(p_brand, 7) AS INTEGER) * 10 + p_size % 6 AS iid,
                 sum(CAST(l_extendedprice AS {MONEY})) AS rev, sum(CAST(l_quantity AS INTEGER)) AS sold
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
        totals AS (SELECT month, sum(rev) AS rev_all, sum(sold) AS sold_all, count(*) AS n FROM sold_by_month GROUP BY month),
        measured AS (
          SELECT month, iid, rev,
                 CAST(round(1000000.0 * CAST(rev AS DOUBLE) / CAST(rev_all AS DOUBLE)) AS BIGINT) / 10000.0 AS composition,
                 round(100.0 * CAST(sold * n AS DOUBLE) / CAST(sold_all AS DOUBLE)) / 100.0 AS index_value
          FROM sold_by_month JOIN totals USING (month) WHERE {keep}),
        placed AS (
          SELECT *, rank() OVER (PARTITION BY month ORDER BY rev DESC, iid) AS place,
                 count(*) OVER (PARTITION BY month) AS places FROM measured)
        SELECT if(iid % 29 = 0, NULL, strftime(month, '%m-%Y')) AS month_year, CAST(iid AS VARCHAR) AS interest_id,
               composition, index_value, CAST(place AS INTEGER) AS ranking,
               round(10000.0 * (1 - CAST(place - 1 AS DOUBLE) / CAST(places AS DOUBLE))) / 100.0 AS percentile_ranking
        FROM placed"""


VIEW_SQL["v_interest"] = _interest("true")
VIEW_SQL["v_interest_sparse"] = _interest(
    "iid % 10 < 4 OR (iid % 10 = 4 AND year(month) = 1997)"
    " OR (iid % 10 = 5 AND month BETWEEN DATE '1996-01-01' AND DATE '1996-04-01')")


def _deps(name: str) -> list[str]:
    body = VIEW_SQL[name]
    return [v for v in VIEW_SQL if v != name and re.search(rf"\b{v}\b", body)]


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with ``WITH`` definitions of the named views (dependencies first)."""
    if not names:
        names = tuple(v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql))
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
