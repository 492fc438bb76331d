"""Case 1 on its 15-row published fixture; goldens worked out by hand."""

import datetime as dt

import pytest

from insights.operators import loyalty as L

D = dt.date
# The case's sample data (customer, order date, product).
SALES = [
    ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
    ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3),
    ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2), ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1),
    ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
    ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))]


@pytest.fixture(scope="module")
def frames(spark):
    sales = spark.createDataFrame(
        [(c, d, p, i, 1) for i, (c, d, p) in enumerate(SALES)],
        "customer_id string, order_date date, prod_id int, txn_id int, line_no int")
    menu = spark.createDataFrame(MENU, "product_id int, product_name string, price int") \
        .selectExpr("product_id", "product_name", "cast(price as decimal(12,2)) as price")
    members = spark.createDataFrame(MEMBERS, "customer_id string, join_date date")
    return sales, menu, members


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_spend(frames):
    s, m, _ = frames
    assert {k: int(v) for k, v in as_dict(L.spend_per_customer(s, m), "customer_id", "total_amount").items()} == \
        {"A": 76, "B": 74, "C": 36}


def test_visit_days(frames):
    s, _, _ = frames
    assert as_dict(L.visit_days(s), "customer_id", "number_of_dates") == {"A": 4, "B": 6, "C": 2}


def test_first_items_keep_ties(frames):
    s, m, _ = frames
    rows = sorted((r.customer_id, r.product_name) for r in L.first_purchase_items(s, m).collect())
    assert rows == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen"), ("C", "ramen")]


def test_most_purchased(frames):
    s, m, _ = frames
    r = L.most_purchased_item(s, m).collect()
    assert [(x.product_name, x.nb_time) for x in r] == [("ramen", 8)]


def test_favourite_with_ties(frames):
    s, m, _ = frames
    rows = sorted((r.customer_id, r.product_name, r.max_nb_time) for r in L.favourite_item_per_customer(s, m).collect())
    assert rows == [("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3)]


def test_first_after_join(frames):
    s, m, mem = frames
    rows = sorted((r.customer_id, r.product_name) for r in L.first_item_after_join(s, m, mem).collect())
    assert rows == [("A", "curry"), ("B", "sushi")]


def test_last_before_join(frames):
    s, m, mem = frames
    rows = sorted((r.customer_id, r.product_name) for r in L.last_item_before_join(s, m, mem).collect())
    assert rows == [("A", "curry"), ("A", "sushi"), ("B", "sushi")]


def test_pre_join_totals(frames):
    s, m, mem = frames
    rows = sorted((r.customer_id, r.total_item, int(r.total_amount)) for r in L.pre_join_totals(s, m, mem).collect())
    assert rows == [("A", 2, 25), ("B", 3, 40)]


def test_points(frames):
    s, m, _ = frames
    pts = {k: int(v) for k, v in as_dict(L.loyalty_points(s, m, (1,)), "customer_id", "points").items()}
    assert pts == {"A": 860, "B": 940, "C": 360}


def test_points_first_week(frames):
    s, m, mem = frames
    df = L.loyalty_points_first_week(s, m, mem, D(2021, 1, 31), ["A", "B"], (1,))
    assert {k: int(v) for k, v in as_dict(df, "customer_id", "points").items()} == {"A": 1370, "B": 820}


def test_member_ranking(frames):
    s, m, mem = frames
    rows = sorted((r.customer_id, r.order_date, r.product_name, r.member, r.ranking)
                  for r in L.member_ranked_sales(s, m, mem).collect())
    a = [x for x in rows if x[0] == "A"]
    assert [x[4] for x in a] == [None, None, 1, 2, 3, 3]
    assert all(x[4] is None for x in rows if x[0] == "C")
