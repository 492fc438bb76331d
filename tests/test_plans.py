"""Physical-plan shape checks: the optimisations the operators rely on."""

import datetime as dt

from insights.plans import report as R
from insights.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_group_uses_partial_window_group_limit(views001):
    p = plan(QUERIES["top_product_per_segment"](views001))
    assert "WindowGroupLimit" in p


def test_month_filter_reaches_parquet_scan(views001):
    df = R.sales_in_month(views001.v_sales, 1997, 1)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_rank_by_has_no_window_over_raw_rows(views001):
    p = plan(QUERIES["member_ranked_sales"](views001))
    # the only window sorts (customer, member, order_date) counts, after an aggregate
    assert p.count("Window ") <= 1 and "HashAggregate" in p


def test_no_nested_loop_join_except_allowed(views001):
    # literal one-row maps, one-row totals and the 3-row campaign range join are the only
    # nested-loop joins; their build sides are bounded by construction
    allowed = {"visit_summary", "campaign_uplift", "campaign_metrics", "order_item_label", "ingredient_list_2x",
               "product_penetration", "monthly_product_report_product_penetration", "largest_delivered_orders",
               "top_bottom_composition", "interests_in_all_months", "daily_running_balance",
               "monthly_balance_dense", "balance_stats", "allocation_prev_month", "allocation_avg_30d",
               "allocation_realtime", "member_txn_split", "category_share", "monthly_product_report_category_share",
               "plan_after_trial", "plan_mix_at_date", "days_to_annual_buckets", "retail_contribution",
               "product_share_in_segment",
               # exact_quantiles: ≤ 2·k target ranks beside the counted values
               "txn_revenue_percentiles", "monthly_txn_report",
               # one-row bounds and totals
               "composition_ranks", "hardest_hit_segments"}
    bad = []
    for k, f in QUERIES.items():
        if k in allowed:
            continue
        if "BroadcastNestedLoopJoin" in plan(f(views001)):
            bad.append(k)
    assert bad == []


# tables that each of these keys may read: a sales column pulls in the table that carries it, and no other
SCANS = {
    "total_quantity": {"lineitem"}, "unique_transactions": {"lineitem"}, "gross_revenue": {"lineitem", "part"},
    "top_product_per_segment": {"lineitem", "part"}, "segment_totals": {"lineitem", "part"},
    "product_penetration": {"lineitem", "part"},
    "visit_days": {"lineitem", "orders"}, "loyalty_points": {"lineitem", "orders", "part"},
    "member_txn_split": {"lineitem", "orders", "customer"}, "items_ordered": {"lineitem"}, "top_extra": {"lineitem"},
    "revenue_fixed_price": {"lineitem", "orders"}, "unique_nodes": {"orders", "customer", "nation"},
    "monthly_product_report_category_share": {"lineitem", "orders", "part"},
}


def test_keys_read_only_the_tables_of_their_columns(views001):
    import re
    for key, tables in SCANS.items():
        assert set(re.findall(r"sf0\.001/(\w+)\.parquet", plan(QUERIES[key](views001)))) == tables, key


# keys that write intermediates: a level or a range partitioning that later steps read
STEPWISE = {"top_product_triple", "monthly_product_report_top_product_triple", "top_product_pairs", "composition_ranks",
            "hierarchy_paths", "kept_up_funnel", "txn_amount_sketch"}


def test_building_a_query_starts_no_job(spark, views001):
    for name in ("lineitem", "orders", "part", "customer", "nation", "region", "supplier", "events"):
        views001.t.table(name)  # reading a schema is a job of its own
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        for k, f in QUERIES.items():
            if k not in STEPWISE:
                f(views001)
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_balances_have_no_row_per_customer_and_day(views001):
    """The amounts are scanned once per (customer, day) shuffle, all else reads dates alone; no grid of days."""
    import re
    for key, scans in (("balance_stats", 1), ("allocation_prev_month", 1), ("allocation_avg_30d", 1), ("allocation_realtime", 2)):
        df = QUERIES[key](views001)
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        read = re.findall(r"ReadSchema: struct<([^>]*)>", final)
        assert 1 <= sum("o_totalprice" in r for r in read) <= scans, key
        assert all("o_totalprice" in r or r == "o_orderdate:timestamp_ntz" or r == "o_orderdate:timestamp" for r in read), (key, read)
        assert "1 days" not in final and "interval 1 day" not in final.lower(), key


# keys whose view was read once for the rows and once more for a count
ONE_SCAN = ["interests_in_all_months", "rows_removed_below_threshold", "unique_interests_per_month",
            "top_bottom_composition", "lowest_avg_ranking", "most_volatile_interests", "volatile_extremes",
            "top10_avg_composition_per_month", "top10_appearances", "avg_of_top10_per_month", "rolling_max_composition",
            "product_penetration"]


def test_sales_are_scanned_once(views001):
    import re
    scans = {}
    for key in ONE_SCAN:
        df = QUERIES[key](views001)
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        # a stage that is used again (ReusedExchange) prints its plan again with the same column ids
        scans[key] = len(set(re.findall(r"FileScan parquet [^\n]*lineitem", final)))
    assert scans == dict.fromkeys(ONE_SCAN, 1)
