"""Check SQL (DuckDB) for case 4, written from the questions: balances are levels between flows."""

from .sqlfn import MONEY, PCT, RATIO, RD
from .views import with_views

FLOW = "sum(txn_amount * if(txn_type = 'deposit', 1, -1))"
CLOSED = "end_date BETWEEN start_date AND DATE '9999-12-30'"


def _levels(table: str, at: str, step: str) -> str:
    """Level per customer after each flow, and at every period of the data's span (``filled``)."""
    return f"""
    WITH flows AS (SELECT customer_id AS who, {at} AS dt, {FLOW} AS flow FROM {table} GROUP BY ALL),
    levels AS (SELECT who, dt, sum(flow) OVER (PARTITION BY who ORDER BY dt) AS level FROM flows),
    periods AS (SELECT CAST(unnest(range(CAST(min(dt) AS TIMESTAMP), CAST(max(dt) AS TIMESTAMP) + INTERVAL {step},
                                         INTERVAL {step})) AS DATE) AS dt FROM flows),
    filled AS (
      SELECT spots.who, spots.dt, CAST(coalesce(level, 0) AS DECIMAL(18,2)) AS level
      FROM (SELECT who, periods.dt FROM (SELECT DISTINCT who FROM flows), periods) spots
        ASOF LEFT JOIN levels ON levels.who = spots.who AND spots.dt >= levels.dt)"""


_DAILY = _levels("v_txns_daily", "txn_date", "1 DAY")
_YEARS = _levels("v_txns_monthly", "txn_date", "1 DAY")
_MONTHLY = _levels("v_txns_monthly", "make_date(year(txn_date), month(txn_date), 1)", "1 MONTH")
_MONTH = "CAST(date_trunc('month', dt) AS DATE)"


def _per_region(what: str, name: str) -> str:
    return f"""
        SELECT region_id, region_name, count(*) AS {name}
        FROM (SELECT DISTINCT region_id, {what} FROM v_node_stays) JOIN v_regions USING (region_id) GROUP BY ALL"""


SQL = {
    "unique_nodes": "SELECT count(*) AS unique_nodes FROM (SELECT DISTINCT node_id FROM v_node_stays)",
    "nodes_per_region": _per_region("node_id", "nodes_per_region"),
    "customers_per_region": _per_region("customer_id", "unique_customers"),
    "avg_stay_days": f"""
        SELECT {RATIO(f'sum(end_date - start_date) FILTER ({CLOSED})', f'count(*) FILTER ({CLOSED})', 0)}
                   AS avg_reallocation_days FROM v_node_stays""",
    "stay_percentiles_by_region": f"""
        SELECT region_name, {', '.join(f"{RD(f'q[{i}]')} AS percentile_{p}" for i, p in ((1, 50), (2, 80), (3, 95)))}
        FROM (SELECT region_id, quantile_cont(end_date - start_date, [0.5, 0.8, 0.95]) AS q
              FROM v_node_stays WHERE {CLOSED} GROUP BY region_id) JOIN v_regions USING (region_id)""",
    "txn_type_totals": f"""
        SELECT txn_type, count(*) AS unique_count, {MONEY('sum(txn_amount)')} AS total_amount
        FROM v_txns_monthly GROUP BY ALL""",
    "avg_deposits": f"""
        WITH paid_in AS (
          SELECT count(*) AS times, CAST(round(1000000.0 * CAST(sum(txn_amount) AS DOUBLE) / count(*)) AS BIGINT) AS mean
          FROM v_txns_monthly WHERE txn_type = 'deposit' GROUP BY customer_id)
        SELECT {RATIO('sum(times)', 'count(*)', 0)} AS avg_total_deposits,
               {RATIO('sum(mean)', 'count(*) * 1000000', 2)} AS avg_amount FROM paid_in""",
    "txn_amount_percentiles": f"""
        SELECT txn_type, {', '.join(f"{RD(f'q[{i}] / 100.0')} AS {n}" for i, n in ((1, 'p25'), (2, 'p50'), (3, 'p95')))}
        FROM (SELECT txn_type, quantile_cont(CAST(txn_amount * 100 AS BIGINT), [0.25, 0.5, 0.95]) AS q
              FROM v_txns_monthly GROUP BY txn_type)""",
    "txn_amount_sketch": f"""
        WITH placed AS (
          SELECT txn_type, year(txn_date) AS txn_year, CAST(txn_amount * 100 AS BIGINT) AS cents,
                 row_number() OVER per AS r, count(*) OVER (PARTITION BY txn_type, date_trunc('month', txn_date)) AS n
          FROM v_txns_monthly WINDOW per AS (PARTITION BY txn_type, date_trunc('month', txn_date) ORDER BY txn_amount)),
        stored AS (
          SELECT *, (r * least(n, 50) // n - (r - 1) * least(n, 50) // n) * greatest(n, 50) AS w FROM placed),
        running AS (
          SELECT *, sum(w) OVER (PARTITION BY txn_type, txn_year ORDER BY cents) AS upto,
                 sum(w) OVER (PARTITION BY txn_type, txn_year) AS total FROM stored WHERE w > 0)
        SELECT txn_type, CAST(txn_year AS INTEGER) AS txn_year, CAST(any_value(total) // 50 AS BIGINT) AS txn_count,
               {', '.join(f"{RD(f'min(cents) FILTER (upto >= greatest(ceil({p} * CAST(total AS DOUBLE)), 1)) / 100.0')} AS {c}"
                          for c, p in (('p25', 0.25), ('p50', 0.5), ('p95', 0.95)))}
        FROM running GROUP BY txn_type, txn_year""",
    "active_customers_per_month": """
        SELECT txn_month, count(*) AS customer_count
        FROM (SELECT make_date(year(txn_date), month(txn_date), 1) AS txn_month, customer_id FROM v_txns_monthly
              GROUP BY ALL HAVING count(*) FILTER (txn_type = 'deposit') >= 2 AND bool_or(txn_type <> 'deposit'))
        GROUP BY txn_month""",
    "monthly_closing_balance": f"""{_MONTHLY}
        SELECT who AS customer_id, dt AS txn_month, CAST(level AS DECIMAL(18,2)) AS closing_balance FROM levels""",
    "pct_balance_growth": f"""{_MONTHLY},
        ends AS (SELECT arg_min(level, dt) AS opening, arg_max(level, dt) AS closing FROM levels
                 GROUP BY who HAVING count(*) > 1)
        SELECT {PCT('count(*) FILTER (opening > 0 AND closing > opening * 1.05)', 'count(*)')} AS customers_5pct
        FROM ends""",
    "daily_running_balance": f"{_DAILY} SELECT who AS customer_id, dt AS day, level AS running_balance FROM filled",
    "monthly_balance_dense": f"{_MONTHLY} SELECT who AS customer_id, dt AS month, level AS closing_balance FROM filled",
    "balance_stats": f"""{_YEARS}
        SELECT who AS customer_id, min(level) AS min_balance, {RATIO('sum(level)', 'count(*)')} AS avg_balance,
               max(level) AS max_balance FROM filled GROUP BY who""",
    "allocation_prev_month": f"""{_MONTHLY}
        SELECT CAST(dt + INTERVAL 1 MONTH AS DATE) AS month,
               CAST(round(sum(level)) AS DECIMAL(18,0)) AS total_allocation_option1
        FROM filled WHERE dt < (SELECT max(dt) FROM periods) GROUP BY dt""",
    "allocation_avg_30d": f"""{_YEARS},
        month_ends AS (SELECT max(dt) AS dt FROM periods GROUP BY {_MONTH}),
        means AS (  -- of the last thirty days up to each month's last day
          SELECT month_ends.dt, CAST(round(1000000.0 * CAST(sum(level) AS DOUBLE) / count(*)) AS BIGINT) AS mean
          FROM month_ends JOIN filled ON filled.dt > month_ends.dt - 30 AND filled.dt <= month_ends.dt
          GROUP BY month_ends.dt, who)
        SELECT {_MONTH} AS month, {RATIO('sum(mean)', '1000000', 0)} AS total_allocation_option2
        FROM means GROUP BY ALL""",
    "allocation_realtime": f"""{_YEARS},
        peaks AS (SELECT {_MONTH} AS month, max(level) AS peak FROM filled GROUP BY month, who)
        SELECT month, CAST(round(sum(peak)) AS DECIMAL(18,0)) AS total_allocation_option3 FROM peaks GROUP BY month""",
}
SQL = {k: with_views(v) for k, v in SQL.items()}
