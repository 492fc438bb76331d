"""Check SQL (DuckDB) for case 1, written from the questions."""

from .sqlfn import MONEY
from .views import with_views

BONUS = 1
END_DATE = "DATE '1996-01-31'"

# each member's sales with the days between joining and buying (negative: before)
_SINCE = """
    WITH bought AS (
      SELECT customer_id, order_date, txn_id, line_no, product_id, product_name, cost, order_date - join_date AS days
      FROM v_sales JOIN v_members USING (customer_id)
        JOIN (SELECT product_id, product_name, price AS cost FROM v_product) ON product_id = prod_id)"""

_FLAGGED = """
    SELECT customer_id, order_date, product_name, v_product.price,
           if(coalesce(order_date >= join_date, false), 'Y', 'N') AS member
    FROM v_product JOIN v_sales ON prod_id = product_id LEFT JOIN v_members USING (customer_id)"""

SQL = {
    "spend_per_customer": f"""
        SELECT customer_id, {MONEY('sum(times * coalesce(cost, 0))')} AS total_amount
        FROM (SELECT customer_id, prod_id, count(*) AS times FROM v_sales GROUP BY ALL)
          LEFT JOIN (SELECT product_id AS prod_id, price AS cost FROM v_product) USING (prod_id)
        GROUP BY customer_id""",
    "visit_days": """
        SELECT customer_id, count(*) AS number_of_dates
        FROM (SELECT DISTINCT customer_id, order_date FROM v_sales) GROUP BY customer_id""",
    "first_purchase_items": """
        SELECT customer_id, product_name, product_id FROM v_product JOIN v_sales ON prod_id = product_id
        QUALIFY order_date = min(order_date) OVER (PARTITION BY customer_id)""",
    "most_purchased_item": """
        SELECT product_id, product_name, count(*) AS nb_time FROM v_product JOIN v_sales ON prod_id = product_id
        GROUP BY product_id, product_name QUALIFY row_number() OVER (ORDER BY count(*) DESC, product_id) = 1""",
    "favourite_item_per_customer": """
        SELECT customer_id, product_id, product_name, count(*) AS max_nb_time
        FROM v_product JOIN v_sales ON prod_id = product_id
        GROUP BY customer_id, product_id, product_name QUALIFY count(*) = max(count(*)) OVER (PARTITION BY customer_id)""",
    "first_item_after_join": f"""{_SINCE}
        SELECT customer_id, pick.name AS product_name, pick.id AS product_id
        FROM (SELECT customer_id, min({{'d': order_date, 't': txn_id, 'l': line_no, 'id': product_id,
                                        'name': product_name}}) AS pick
              FROM bought WHERE days >= 0 GROUP BY customer_id)""",
    "last_item_before_join": f"""{_SINCE}
        SELECT customer_id, product_name, product_id FROM bought WHERE days < 0
        QUALIFY days = max(days) OVER (PARTITION BY customer_id)""",
    "pre_join_totals": f"""{_SINCE}
        SELECT customer_id, count(*) FILTER (days < 0) AS total_item,
               {MONEY('sum(cost) FILTER (days < 0)')} AS total_amount
        FROM bought GROUP BY customer_id HAVING bool_or(days < 0)""",
    "loyalty_points": f"""
        SELECT customer_id, {MONEY(f'10 * sum(v_product.price * if(product_id = {BONUS}, 2, 1))')} AS points
        FROM v_product JOIN v_sales ON prod_id = product_id GROUP BY customer_id""",
    "loyalty_points_first_week": f"""{_SINCE}
        SELECT customer_id, {MONEY(f'10 * sum(cost * if(product_id = {BONUS} OR (days >= 0 AND days <= 6), 2, 1))')}
                   AS points
        FROM bought WHERE order_date <= {END_DATE} GROUP BY customer_id""",
    "joined_sales_flag": _FLAGGED,
    "member_ranked_sales": f"""
        WITH flagged AS ({_FLAGGED}),
        before AS (  -- rows of the same customer and flag on earlier days, from counts per day
          SELECT customer_id, member, order_date,
                 sum(count(*)) OVER (PARTITION BY customer_id, member ORDER BY order_date) - count(*) AS earlier
          FROM flagged GROUP BY customer_id, member, order_date)
        SELECT flagged.*, CAST(if(member = 'Y', earlier + 1, NULL) AS INTEGER) AS ranking
        FROM flagged JOIN before USING (customer_id, member, order_date)""",
}
SQL = {k: with_views(v) for k, v in SQL.items()}
