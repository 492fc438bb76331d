"""Item texts worded once per form, and busy days counted before they are ranked: small cases in full."""

import datetime as dt
from collections import Counter

from insights.operators import basket as B
from insights.operators import delivery as D
from insights.operators import loyalty as L
from insights.operators import segments as G

TOPPINGS = {1: "Bacon", 2: "Ant", 3: "Cheese", 4: "Dill"}
RECIPES = [(1, "Plain", "3, 1"), (2, "Bare", None)]
CELLS = [None, "", "null", " NULL ", "1", "1, 3", "3,1", "9", "4, 9", "2, 2"]


def _frames(spark):
    rows = [(n, 1, n % 2 + 1, CELLS[n % 10], CELLS[n // 10 % 10]) for n in range(200)] + [(500, 1, None, "1", "2"), (501, 1, 7, "1", "2")]
    items = spark.createDataFrame(rows, "order_id long, item_no int, pizza_id int, exclusions string, extras string")
    recipes = spark.createDataFrame(RECIPES, "pizza_id int, pizza_name string, toppings string")
    toppings = spark.createDataFrame(list(TOPPINGS.items()), "topping_id int, topping_name string")
    return rows, items, recipes, toppings


def _ids(cell):
    return [] if cell is None or cell.strip().lower() in ("", "null") else [int(x) for x in cell.split(",")]


def _names(ids):
    return sorted(TOPPINGS[i] for i in ids if i in TOPPINGS)


def test_labels_equal_plain_wording(spark):
    rows, items, recipes, toppings = _frames(spark)
    want = {}
    for o, _, p, ex, add in rows:
        if p in (1, 2):
            text = dict((r[0], r[1]) for r in RECIPES)[p]
            text += f" - Exclude {', '.join(_names(_ids(ex)))}" if _names(_ids(ex)) or _ids(ex) else ""
            text += f" - Extra {', '.join(_names(_ids(add)))}" if _ids(add) else ""
            want[o] = text
    got = D.order_item_label(items, recipes, toppings, None)
    assert {r.order_id: r.order_item for r in got.collect()} == want
    one = D.order_item_label(items, recipes, toppings, "Plain").collect()
    assert {r.order_id: r.order_item for r in one} == {o: t for o, t in want.items() if t.startswith("Plain")}


def test_ingredient_lists_equal_plain_wording(spark):
    rows, items, recipes, toppings = _frames(spark)
    base = {r[0]: (r[1], _ids(r[2])) for r in RECIPES}
    want = {}
    for o, _, p, ex, add in rows:
        if p in base:
            name, ids = base[p]
            kept = [i for i in ids if i not in _ids(ex)]
            shown = sorted((TOPPINGS[i], i in kept and i in _ids(add)) for i in {*kept, *_ids(add)} if i in TOPPINGS)
            want[o] = f"{name}: " + ", ".join(("2x" if twice else "") + n for n, twice in shown)
    got = D.ingredient_list_2x(items, recipes, toppings).collect()
    assert len(got) == len(want) and {r.order_id: r.ingredient_list for r in got} == want


def test_labels_of_no_items(spark):
    _, items, recipes, toppings = _frames(spark)
    assert D.order_item_label(items.limit(0), recipes, toppings).columns == ["order_id", "item_no", "order_item"]
    assert D.ingredient_list_2x(items.limit(0), recipes, toppings).collect() == []


def test_standard_ingredients_without_toppings(spark):
    _, _, recipes, toppings = _frames(spark)
    got = {r.pizza_name: r.standard_ingredients for r in D.standard_ingredients(recipes, toppings).collect()}
    assert got == {"Plain": "Bacon, Cheese", "Bare": ""}


def test_busy_first_day_keeps_every_sale(spark):
    day = dt.date(2021, 1, 1)
    rows = [(1, day, i % 2, i, 1) for i in range(500)] + [(1, dt.date(2021, 1, 2), 1, 900, 1), (2, day, 1, 901, 1)]
    sales = spark.createDataFrame(rows, "customer_id int, order_date date, prod_id int, txn_id int, line_no int")
    menu = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "product_id int, product_name string, price int")
    got = Counter((r.customer_id, r.product_name) for r in L.first_purchase_items(sales, menu).collect())
    assert got == {(1, "a"): 250, (1, "b"): 250, (2, "b"): 1}
    members = spark.createDataFrame([(1, dt.date(2021, 1, 2)), (2, day)], "customer_id int, join_date date")
    got = Counter((r.customer_id, r.product_name) for r in L.last_item_before_join(sales, menu, members).collect())
    assert got == {(1, "a"): 250, (1, "b"): 250}


def test_penetration_with_null_products_and_transactions(spark):
    rows = [(1, 1), (1, 1), (1, 2), (2, 1), (3, None), (4, 9), (None, 1), (None, 2)]
    sales = spark.createDataFrame(rows, "txn_id int, prod_id int")
    product = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "none")], "product_id int, product_name string")
    got = {r.product_name: float(r.penetration_percentage) for r in B.product_penetration(sales, product).collect()}
    assert got == {"a": 50.0, "b": 25.0}


def test_coverage_of_interests_with_repeated_rows(spark):
    m = [dt.date(2020, i, 1) for i in range(1, 9)]
    rows = [(d, "1", 5.0) for d in m] + [(m[0], "2", 9.0)] * 20 + [(d, "3", 1.0) for d in m[:6]] + [(m[1], "3", 1.0)]
    metrics = spark.createDataFrame(rows, "month_year date, interest_id string, composition double")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, interest_name string")
    assert G.rows_removed_below_threshold(metrics).first().removed_rows == 20
    assert G.rows_removed_below_threshold(metrics.limit(0)).first().removed_rows == 0
    assert G.keep_qualified(metrics).count() == 15
    assert [(r.interest_name, r.month_count) for r in G.interests_in_all_months(metrics, names).collect()] == [("one", 8)]
    best = {(r.category, r.interest_name): r.month_year for r in G.top_bottom_composition(metrics, names, 1).collect()}
    assert best == {("Top 1", "one"): m[0], ("Bottom 1", "three"): m[0]}
    per = {r.month_year: r.unique_interest_count for r in G.unique_interests_per_month(metrics).collect()}
    assert per == {d: 2 if i < 6 else 1 for i, d in enumerate(m)}
