"""Check SQL (DuckDB) for case 8, written from the questions."""

from .sqlfn import PCT, RATIO
from .views import with_views

INTEREST_ID = 11
START, END = "DATE '1997-01-01'", "DATE '1997-12-01'"

BASE = """
    typed AS (
      SELECT * REPLACE (make_date(CAST(right(month_year, 4) AS INTEGER), CAST(left(month_year, 2) AS INTEGER), 1)
                        AS month_year) FROM v_interest),
    known AS (SELECT * FROM typed WHERE month_year > DATE '0001-01-01'),
    coverage AS (SELECT interest_id, len(list(DISTINCT month_year)) AS months FROM known GROUP BY interest_id),
    enough AS (SELECT known.*, months FROM known JOIN coverage USING (interest_id) WHERE months > 5),
    named AS (SELECT enough.*, interest_name FROM enough JOIN v_interest_map ON id = CAST(interest_id AS INTEGER))"""

_MEAN = RATIO("composition", "index_value")
TOP = f"""
    placed AS (
      SELECT month_year, interest_name, {_MEAN} AS avg_composition,
             (SELECT count(*) FROM enough e WHERE e.month_year = named.month_year
                AND {RATIO('e.composition', 'e.index_value')} > {RATIO('named.composition', 'named.index_value')}) AS above
      FROM named),
    best_ten AS (SELECT month_year, interest_name, avg_composition, CAST(above + 1 AS INTEGER) AS rank_in_month
                FROM placed WHERE above < 10)"""

# spread of whole hundredths, exact until the root
_H = "CAST(round(percentile_ranking * 100) AS BIGINT)"
SPREAD = (f"(round((sqrt(CAST(count({_H}) * sum({_H} * {_H}) - sum({_H}) * sum({_H}) AS DOUBLE)"
          f" / nullif(CAST(count(*) * (count(*) - 1) AS DOUBLE), 0.0)) / 100.0) * 100) / 100.0)")


def _q(sql: str) -> str:
    return f"WITH {BASE.strip()}\n{sql}"


# keys that ask which interests cover which months read the thinned view
SPARSE = ("ids_missing_in_map", "ids_missing_in_metrics", "interests_in_all_months", "cumulative_pct_by_months",
          "rows_removed_below_threshold", "unique_interests_per_month", "qualified_interests")


def _ends(side: str, order: str) -> str:
    return f"""SELECT '{side}' AS category, interest_name, month_year, composition FROM peaks
               WHERE (SELECT count(*) FROM peaks p WHERE p.composition {order} peaks.composition) < 10"""


SQL = {
    "month_year_to_date": _q("FROM typed"),
    "records_per_month": _q("SELECT month_year, count(*) AS record_count FROM typed GROUP BY ALL"),
    "drop_null_months": _q("FROM known"),
    "ids_missing_in_map": _q("""
        SELECT count(*) AS nb_missing_in_map FROM coverage
        WHERE NOT EXISTS (FROM v_interest_map WHERE id = CAST(interest_id AS INTEGER))"""),
    "ids_missing_in_metrics": _q("""
        SELECT count(*) AS orphan_map_ids
        FROM (SELECT id FROM v_interest_map EXCEPT SELECT CAST(interest_id AS INTEGER) FROM coverage)"""),
    "map_duplicate_check": """
        SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_ids
        FROM (SELECT id, count(*) AS n FROM v_interest_map GROUP BY id)""",
    "joined_interest_rows": _q(f"""
        SELECT known.*, interest_name, interest_summary, created_at, last_modified
        FROM v_interest_map JOIN known ON id = CAST(interest_id AS INTEGER) WHERE id = {INTEREST_ID}"""),
    "records_before_creation": _q("""
        SELECT count(*) FILTER (month_year < CAST(created_at AS DATE)) AS nb_records_before_creation
        FROM v_interest_map JOIN known ON id = CAST(interest_id AS INTEGER)"""),
    "interests_in_all_months": _q("""
        SELECT interest_id, interest_name, months AS month_count
        FROM coverage JOIN v_interest_map ON id = CAST(interest_id AS INTEGER)
        WHERE months = (SELECT len(list(DISTINCT month_year)) FROM known)"""),
    "cumulative_pct_by_months": _q(f"""
        , sizes AS (SELECT months, count(*) AS n FROM coverage GROUP BY months)
        SELECT s.months AS total_months, any_value(s.n) AS num_interests,
               {PCT('sum(more.n)', '(SELECT count(*) FROM coverage)')} AS cumulative_percentage
        FROM sizes s JOIN sizes more ON more.months >= s.months GROUP BY s.months"""),
    "rows_removed_below_threshold": _q("""
        SELECT (SELECT count(*) FROM known) - (SELECT count(*) FROM enough) AS removed_rows"""),
    "unique_interests_per_month": _q("""
        SELECT month_year, count(*) AS unique_interest_count
        FROM (SELECT DISTINCT month_year, interest_id FROM enough) GROUP BY month_year"""),
    "composition_ranks": _q("""
        SELECT interest_id, month_year, composition,
               rank() OVER (ORDER BY composition NULLS FIRST) AS rank_asc,
               rank() OVER (ORDER BY composition DESC NULLS LAST) AS rank_desc,
               dense_rank() OVER (ORDER BY composition NULLS FIRST) AS dense_rank_asc FROM known"""),
    "top_bottom_composition": _q(f"""
        , peaks AS (
          SELECT interest_name, max(composition) AS composition,
                 arg_max(month_year, {{'c': composition, 'before': -epoch(month_year)}}) AS month_year
          FROM named GROUP BY interest_id, interest_name)
        {_ends('Top 10', '>')} UNION ALL {_ends('Bottom 10', '<')}"""),
    "lowest_avg_ranking": _q(f"""
        SELECT interest_id, interest_name, {RATIO('sum(ranking)', 'count(*)')} AS avg_ranking FROM named
        GROUP BY interest_id, interest_name
        QUALIFY row_number() OVER (ORDER BY {RATIO('sum(ranking)', 'count(*)')}, interest_id) <= 5"""),
    "most_volatile_interests": _q(f"""
        SELECT interest_name, {SPREAD} AS stddev_ranking FROM named GROUP BY interest_name
        QUALIFY row_number() OVER (ORDER BY {SPREAD} DESC, interest_name) <= 5"""),
    "volatile_extremes": _q(f"""
        SELECT interest_name, min(percentile_ranking) AS min_percentile,
               min(struct_pack(p := percentile_ranking, m := month_year)).m AS month_year_min,
               max(percentile_ranking) AS max_percentile,
               max(struct_pack(p := percentile_ranking, m := month_year)).m AS month_year_max, {SPREAD} AS stddev_percentile
        FROM named GROUP BY interest_id, interest_name
        QUALIFY row_number() OVER (ORDER BY {SPREAD} DESC, interest_name) <= 5"""),
    "top10_avg_composition_per_month": _q(f", {TOP.strip()} FROM best_ten"),
    "top10_appearances": _q(f", {TOP.strip()} SELECT interest_name, count(*) AS times_in_top10 FROM best_ten GROUP BY ALL"),
    "avg_of_top10_per_month": _q(f""", {TOP.strip()}
        SELECT month_year, {RATIO('sum(CAST(round(avg_composition * 100) AS BIGINT))', 'count(*) * 100')}
                   AS avg_of_avg_composition FROM best_ten GROUP BY ALL"""),
    "rolling_max_composition": _q(f"""
        , first AS (
          SELECT month_year, interest_name, {_MEAN} AS mean FROM named
          QUALIFY row_number() OVER (PARTITION BY month_year ORDER BY {_MEAN} DESC, interest_name) = 1),
        numbered AS (
          SELECT *, row_number() OVER (ORDER BY month_year) AS nth,
                 interest_name || ': ' || CAST(CAST(mean AS DECIMAL(10,2)) AS VARCHAR) AS said FROM first)
        SELECT now.month_year, now.interest_name, now.mean AS max_index_composition,
               {RATIO('sum(CAST(round(span.mean * 100) AS BIGINT))', 'count(*) * 100')} AS moving_avg_3m,
               max(span.said) FILTER (span.nth = now.nth - 1) AS one_month_ago,
               max(span.said) FILTER (span.nth = now.nth - 2) AS two_months_ago
        FROM numbered now JOIN numbered span ON span.nth BETWEEN now.nth - 2 AND now.nth
        WHERE now.month_year BETWEEN {START} AND {END} GROUP BY ALL"""),
    "qualified_interests": _q("SELECT interest_id, months AS month_count FROM coverage WHERE months > 5"),
}
SQL = {k: with_views(v.replace("FROM v_interest)", "FROM v_interest_sparse)"), "v_interest_sparse", "v_interest_map")
       if k in SPARSE else with_views(v, "v_interest", "v_interest_map") for k, v in SQL.items()}
