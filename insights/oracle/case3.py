"""Check SQL (DuckDB) for case 3, written from the questions."""

from .sqlfn import MONEY, PCT, RATIO
from .views import with_views

CUSTOMERS = "(1, 4, 7, 10, 22, 25, 31, 40)"
SINCE = "DATE '2000-01-01'"
AT = "DATE '1996-12-31'"
YEAR = 1997
IN_YEAR = f"year(start_date) = {YEAR}"

# each customer's plans in order, as one list
_PATHS = """
    WITH paths AS (
      SELECT customer_id, list(plan_id ORDER BY start_date, event_id) AS plans FROM v_plan_events GROUP BY customer_id)"""

_WAITS = """
    WITH waits AS (
      SELECT min(start_date) FILTER (plan_id = 3) - min(start_date) AS days
      FROM v_plan_events GROUP BY customer_id HAVING bool_or(plan_id = 3))"""

_REVENUE = f"""
    SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, {MONEY('sum(amount)')} AS mrr
    FROM v_plan_events WHERE plan_id BETWEEN 1 AND 3 GROUP BY ALL"""

# Waiting time buckets, in order.
_BUCKETS = ("0-30 days", "31-60 days", "61-90 days", "91-120 days", "121-150 days", "151-180 days", "over 180 days")
_NO = "CAST(greatest(1, least(7, ceil(days / 30.0))) AS INTEGER)"

SQL = {
    "customer_journeys": f"""
        SELECT customer_id, plan_id, plan_name, start_date, amount AS price FROM v_plan_events
        WHERE customer_id IN {CUSTOMERS}""",
    "total_customers": "SELECT count(*) AS total_customers FROM (SELECT DISTINCT customer_id FROM v_plan_events)",
    "trials_per_month": """
        SELECT make_date(year(start_date), month(start_date), 1) AS month_start, count(*) AS nb_trials
        FROM v_plan_events WHERE plan_id = 0 GROUP BY ALL""",
    "plan_events_after": f"""
        SELECT plan_name, count(*) AS nb_events FROM v_plan_events WHERE NOT start_date < {SINCE} GROUP BY ALL""",
    "churn_rate": f"""{_PATHS}
        SELECT count(*) FILTER (plans[-1] = 4) AS nb_churn, count(*) AS total_customers,
               {PCT('count(*) FILTER (plans[-1] = 4)', 'count(*)', 1)} AS pct_churn FROM paths""",
    "churn_after_trial": f"""{_PATHS}
        SELECT count(*) FILTER (plans[:2] = [0, 4]) AS nb_churn_after_trial,
               {PCT('count(*) FILTER (plans[:2] = [0, 4])', 'count(*)', 0)} AS pct_churn_after_trial FROM paths""",
    "plan_after_trial": f"""{_PATHS},
        nexts AS (SELECT plans[2] AS plan_id, count(*) AS nb_customers FROM paths
                  WHERE plans[1] = 0 AND len(plans) > 1 GROUP BY ALL)
        SELECT plan_id, nb_customers, {PCT('nb_customers', '(SELECT sum(nb_customers) FROM nexts)', 1)} AS pct_customers
        FROM nexts""",
    "plan_mix_at_date": f"""
        WITH held AS (
          SELECT max({{'d': start_date, 'e': event_id, 'id': plan_id, 'name': plan_name}}) AS plan
          FROM v_plan_events WHERE start_date <= {AT} GROUP BY customer_id)
        SELECT plan.id AS plan_id, plan.name AS plan_name, count(*) AS nb_customers,
               {PCT('count(*)', '(SELECT count(*) FROM held)', 1)} AS pct
        FROM held GROUP BY ALL""",
    "annual_upgrades_in_year": f"""
        SELECT count(*) AS nb_annual
        FROM (SELECT DISTINCT customer_id FROM v_plan_events WHERE plan_id = 3 AND {IN_YEAR})""",
    "avg_days_to_annual": f"""{_WAITS}
        SELECT {RATIO('sum(days)', 'count(*)', 1)} AS avg_days_to_annual FROM waits""",
    "days_to_annual_buckets": f"""{_WAITS},
        numbered AS (SELECT {_NO} AS bucket_order, count(*) AS nb_customers FROM waits GROUP BY ALL)
        SELECT bucket_order, {list(_BUCKETS)!r}[bucket_order] AS bucket, nb_customers,
               {PCT('nb_customers', '(SELECT count(*) FROM waits)', 1)} AS pct_customers FROM numbered""",
    "downgrades_in_year": f"""
        WITH moves AS (
          SELECT customer_id, start_date, plan_id,
                 lag(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, event_id) AS from_plan
          FROM v_plan_events)
        SELECT count(DISTINCT customer_id) AS nb_downgrades FROM moves
        WHERE from_plan = 2 AND plan_id = 1 AND {IN_YEAR}""",
    "upgrade_paths": """
        WITH bought AS (SELECT customer_id, plan_id, start_date, {'d': start_date, 'e': event_id} AS at FROM v_plan_events)
        SELECT one.customer_id, 1 + max(CASE WHEN three.at IS NOT NULL THEN 2 WHEN two.at IS NOT NULL THEN 1 ELSE 0 END)
                   AS plans_reached, min(three.start_date - one.start_date) AS days
        FROM bought one
        LEFT JOIN bought two ON two.customer_id = one.customer_id AND two.plan_id = 2 AND two.at > one.at
        LEFT JOIN bought three ON three.customer_id = two.customer_id AND three.plan_id = 3 AND three.at > two.at
        WHERE one.plan_id = 1 GROUP BY one.customer_id""",
    "monthly_recurring_revenue": _REVENUE,
    "mrr_growth_rate": f"""
        WITH revenue AS ({_REVENUE}),
        placed AS (SELECT *, row_number() OVER (ORDER BY month) AS nth FROM revenue)
        SELECT here.month, here.mrr, before.mrr AS prev_mrr, {PCT('here.mrr - before.mrr', 'before.mrr')} AS growth_pct
        FROM placed here LEFT JOIN placed before ON before.nth = here.nth - 1""",
}
SQL = {k: with_views(v) for k, v in SQL.items()}
