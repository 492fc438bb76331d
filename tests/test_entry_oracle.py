"""Driver contract and an oracle cross-check on the smallest data set.

Set INSIGHTS_FULL_ORACLE=1 to check every registered key (slow)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from compare import TABLES, rows_multiset  # noqa: E402

SAMPLE = ["top_product_per_segment", "monthly_txn_report", "top_product_triple", "member_ranked_sales",
          "ingredient_list_2x", "delivery_success_pct", "ratings_quality_report", "plan_mix_at_date",
          "downgrades_in_year", "days_to_annual_buckets", "daily_running_balance", "allocation_avg_30d",
          "stay_percentiles_by_region", "clean_weekly_sales", "impact_by_dimension", "visit_summary",
          "product_funnel", "funnel_leaders", "top_bottom_composition", "volatile_extremes",
          "rolling_max_composition", "flatten_hierarchy"]
SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["segment_name", "product_name", "total_quantity"]
    assert df.count() > 0


def test_every_oracle_key_is_registered():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 150


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


KEYS = list(E.queries()) if os.environ.get("INSIGHTS_FULL_ORACLE") else SAMPLE


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        pytest.skip("no SQL twin")
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_multiset(sdf.columns, srows, True) == rows_multiset(dcols, drows, True)
