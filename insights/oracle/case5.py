"""Check SQL (DuckDB) for case 5, written from the questions."""

from .sqlfn import MONEY, PCT, RATIO
from .views import with_views

EVENT = "DATE '1997-06-16'"
DIMENSIONS = ("region", "platform", "age_band", "demographic", "customer_type")

# the raw weekly rows, dated and described
DATED = f"""
    dated AS (
      SELECT day AS week_date, CAST(weekofyear(day) AS INTEGER) AS week_number,
             CAST(month(day) AS INTEGER) AS month_number, CAST(year(day) AS INTEGER) AS calendar_year, region, platform,
             coalesce(nullif(segment, 'null'), 'unknown') AS segment,
             coalesce(map {{'1': 'Young Adults', '2': 'Middle Aged', '3': 'Retirees', '4': 'Retirees'}}[right(segment, 1)],
                      'unknown') AS age_band,
             coalesce(map {{'C': 'Couples', 'F': 'Families'}}[left(segment, 1)], 'unknown') AS demographic,
             customer_type, transactions, sales, {RATIO('sales', 'transactions')} AS avg_transaction
      FROM (SELECT *, CAST(strptime(week_date, '%d/%m/%y') AS DATE) AS day FROM v_weekly_raw))"""


def _q(sql: str) -> str:
    return f"WITH {DATED.strip()}\n{sql}"


def _sides(keys: str, weeks: int) -> str:
    """Sales of the weeks before and from the event on, one row per key."""
    rows = "SELECT *, week_date - {0} AS days FROM dated".format(EVENT)
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
        SELECT {keys + ',' if keys else ''} {MONEY(f'sum(sales) FILTER (days >= {-7 * weeks} AND days < 0)')} AS old,
               {MONEY(f'sum(sales) FILTER (days >= 0 AND days < {7 * weeks})')} AS new
        FROM ({rows}) {group}"""


def _change(variance: str) -> str:
    return f"new - old AS {variance}, {PCT('new - old', 'old')} AS percentage_change"


def _before_after(weeks: int) -> str:
    return _q(f"""SELECT old AS before_sales, new AS after_sales, {_change('sales_variance')}
                  FROM ({_sides('', weeks)})""")


SQL = {
    "clean_weekly_sales": _q("FROM dated"),
    "weekdays_used": _q("""
        SELECT dayname(week_date) AS day_of_week, CAST(dayofweek(week_date) AS INTEGER) AS day_number
        FROM dated GROUP BY ALL"""),
    "missing_weeks": _q("""
        , seen AS (SELECT calendar_year, region, platform, segment, customer_type, list(DISTINCT week_number) AS weeks
                   FROM dated GROUP BY ALL)
        SELECT seen.* EXCLUDE (weeks), CAST(number AS INTEGER) AS missing_week_number
        FROM seen, range(1, 53) numbers(number) WHERE NOT list_contains(weeks, number)"""),
    "transactions_per_year": _q("""
        SELECT calendar_year, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM dated GROUP BY ALL"""),
    "sales_by_region_month": _q(f"""
        SELECT region, month_number, {MONEY('sum(sales)')} AS total_sales FROM dated GROUP BY ALL"""),
    "transactions_by_platform": _q("""
        SELECT platform, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM dated GROUP BY ALL"""),
    "platform_share": _q(f"""
        , part AS (SELECT calendar_year, month_number, platform, {MONEY('sum(sales)')} AS total_sales FROM dated GROUP BY ALL),
        whole AS (SELECT calendar_year, month_number, sum(sales) AS every FROM dated GROUP BY ALL)
        SELECT calendar_year, month_number, platform, total_sales, {PCT('total_sales', 'every')} AS percentage
        FROM part JOIN whole USING (calendar_year, month_number)"""),
    "demographic_share_by_year": _q(f"""
        , whole AS (SELECT calendar_year, sum(sales) AS every FROM dated GROUP BY ALL)
        SELECT calendar_year, demographic, {MONEY('sum(sales)')} AS yearly_demographic_sales,
               {PCT('sum(sales)', 'any_value(every)')} AS percentage_contribution
        FROM dated JOIN whole USING (calendar_year) GROUP BY calendar_year, demographic"""),
    "retail_contribution": _q(f"""
        , retail AS (SELECT * FROM dated WHERE platform = 'Retail')
        SELECT age_band, demographic, {MONEY('sum(sales)')} AS total_retail_sales,
               {PCT('sum(sales)', '(SELECT sum(sales) FROM retail)')} AS contribution_percentage
        FROM retail GROUP BY ALL"""),
    "avg_transaction_size": _q(f"""
        SELECT calendar_year, platform, {MONEY('sum(sales)')} AS total_sales,
               CAST(sum(transactions) AS BIGINT) AS total_transactions,
               {RATIO('sum(sales)', 'sum(transactions)')} AS avg_transaction_size FROM dated GROUP BY ALL"""),
    "before_after": _before_after(4),
    "before_after_12w": _before_after(12),
    # the event falls on the Monday of the same ISO week in every year
    "before_after_by_year": _q(f"""
        , years AS (SELECT DISTINCT calendar_year AS y FROM dated),
        events AS (SELECT y, CAST(strptime(y || '-W' || lpad(CAST(weekofyear({EVENT}) AS VARCHAR), 2, '0') || '-1',
                                           '%G-W%V-%u') AS DATE) AS event FROM years),
        sides AS (
          SELECT y AS calendar_year, {MONEY('sum(sales) FILTER (week_date < event)')} AS old,
                 {MONEY('sum(sales) FILTER (week_date >= event)')} AS new
          FROM events JOIN dated ON week_date >= event - 28 AND week_date < event + 28 GROUP BY ALL)
        SELECT calendar_year, old AS sales_before, new AS sales_after, {_change('variance')} FROM sides"""),
    "hardest_hit_segments": _q(f"""
        , near AS (SELECT *, week_date < {EVENT} AS early FROM dated WHERE abs(week_date - {EVENT} + 0.5) < 84),
        cubed AS (
          SELECT {', '.join(f"if(grouping({d}) = 1, '(all)', coalesce({d}, '(none)')) AS {d}" for d in DIMENSIONS)},
                 CAST({' + '.join(f'1 - grouping({d})' for d in DIMENSIONS)} AS INTEGER) AS n_fixed,
                 {MONEY('coalesce(sum(sales) FILTER (early), 0)')} AS old, {MONEY('coalesce(sum(sales) FILTER (NOT early), 0)')} AS new
          FROM near GROUP BY CUBE ({', '.join(DIMENSIONS)}))
        SELECT {', '.join(DIMENSIONS)}, n_fixed, old AS before_sales, new AS after_sales, {_change('variance')} FROM cubed
        WHERE old >= 0.02 * (SELECT sum(sales) FROM near WHERE early)"""),
    "impact_by_dimension": _q(' UNION ALL '.join(
        f"""SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value, old AS before_sales, new AS after_sales,
                   {_change('variance')} FROM ({_sides(d, 12)})""" for d in DIMENSIONS)),
}
SQL = {k: with_views(v, "v_weekly_raw") for k, v in SQL.items()}
