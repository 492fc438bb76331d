"""Delivery operators over the fixed menu dimensions (not registered as
queries because they read no fact data) and array edge cases."""

from insights.operators import delivery as D
from insights.sources.views import views


def test_standard_ingredients(spark):
    v = views(spark, "/root/testdata/sf0.001")
    got = {r.pizza_name: r.standard_ingredients for r in D.standard_ingredients(v.v_recipes, v.v_toppings).collect()}
    assert got["Vegetarian"] == "Cheese, Garlic, Ham, Olives, Peppers, Tomato Sauce"
    assert got["Meatlovers"] == "Anchovies, Basil, Beef, Cheese, Chicken, Garlic, Mushrooms, Onions"


def test_menu_extension(spark):
    v = views(spark, "/root/testdata/sf0.001")
    rows = {r.pizza_id: (r.pizza_name, r.toppings) for r in D.menu_extension(v.v_recipes, v.v_toppings, 4, "Deluxe").collect()}
    assert len(rows) == 4
    assert rows[4] == ("Deluxe", ", ".join(str(i) for i in range(1, 13)))


def test_ingredient_list_marks_doubled_extras(spark):
    v = views(spark, "/root/testdata/sf0.001")
    items = spark.createDataFrame(
        [(1, 1, 2, "4", "4, 1"), (2, 1, 2, "null", ""), (3, 1, 1, None, "3")],
        "order_id long, item_no int, pizza_id int, exclusions string, extras string")
    got = {r.order_id: r.ingredient_list for r in D.ingredient_list_2x(items, v.v_recipes, v.v_toppings).collect()}
    # cheese (4) excluded then added back: once; anchovies (1) extra only: once
    assert got[1] == "Vegetarian: Anchovies, Cheese, Garlic, Ham, Olives, Peppers, Tomato Sauce"
    assert got[2] == "Vegetarian: Cheese, Garlic, Ham, Olives, Peppers, Tomato Sauce"
    # beef (3) is in the recipe and extra → 2x
    assert got[3] == "Meatlovers: Anchovies, Basil, 2xBeef, Cheese, Chicken, Garlic, Mushrooms, Onions"
