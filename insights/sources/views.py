"""Business views over the driver tables (the inputs of every operator).

Each case study works on a small business schema (sales, orders, plan events,
transactions, clickstream, interest metrics …).  These functions derive those
schemas from the TPC-H-like driver tables, so every operator's work grows with
the data.  The DuckDB twins used as the correctness oracle live in
``insights.oracle.views`` and are written independently in SQL.

Only literal dimension tables (a few rows, fixed by definition) are created
from Python values; everything else is a Spark plan over Parquet.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import Tables

MONEY = "decimal(12,2)"

# Pizza menu (id, name, topping id list as stored text).
RECIPES = [
    (1, "Meatlovers", "1, 2, 3, 4, 5, 6, 8, 10"),
    (2, "Vegetarian", "4, 6, 7, 9, 11, 12"),
    (3, "Supreme", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"),
]
# Topping id → name.
TOPPINGS = [
    (1, "Anchovies"), (2, "Basil"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Garlic"),
    (7, "Ham"), (8, "Mushrooms"), (9, "Olives"), (10, "Onions"), (11, "Peppers"), (12, "Tomato Sauce"),
]
# Shop pages (page_id, page_name, product_category, product_id).
PAGES = [
    (1, "Home Page", None, None), (2, "All Products", None, None),
    (3, "Cod", "Fish", 1), (4, "Mackerel", "Fish", 2), (5, "Sardine", "Fish", 3),
    (6, "Caviar", "Luxury", 4), (7, "Truffle", "Luxury", 5),
    (8, "Clam", "Shellfish", 6), (9, "Crab", "Shellfish", 7), (10, "Mussel", "Shellfish", 8),
    (11, "Shrimp", "Shellfish", 9), (12, "Checkout", None, None), (13, "Confirmation", None, None),
]
# Clickstream event types.
EVENT_TYPES = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"), (4, "Ad Impression"), (5, "Ad Click")]
# Campaigns (id, product id range, name, start, end).
CAMPAIGNS = [
    (1, "1-3", "Spring Catch", "2024-01-01 00:00:00", "2024-01-08 00:00:00"),
    (2, "4-5", "Luxury Week", "2024-01-10 00:00:00", "2024-01-18 00:00:00"),
    (3, "6-9", "Shellfish Days", "2024-01-20 00:00:00", "2024-01-30 00:00:00"),
]
OPEN_END = "9999-12-31"


def literal_table(spark, rows, schema: str) -> DataFrame:
    """A small fixed table built JVM-side (``inline`` of a literal array).

    Unlike ``createDataFrame`` on Python rows it needs no Python worker at
    execution time, and Catalyst sees its exact (tiny) size.
    """
    fields = [f.strip().split() for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _money(c):
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def _order_time():
    """Order timestamp: order date plus a deterministic minute of the day."""
    return F.timestamp_add("MINUTE", (F.col("o_orderkey") * 37) % 1440, F.col("o_orderdate"))


class Views:
    """All re-aimed views of one data directory, built lazily."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.spark = tables.spark

    def materialize(self, *names: str) -> "Views":
        """Write the named views once to the shared checkpoint folder and use
        the files from then on (for pipelines that read a view many times)."""
        from ..plans.sinks import materialize
        for n in names:
            self.__dict__[n] = materialize(getattr(self, n), n)
        return self

    # ---- case 1 and 7: sales, products, members ---------------------------------------
    def sales(self, *columns: str) -> DataFrame:
        """Sales with the asked columns (all by default), joining only the tables that carry them:
        every line has its order, part and customer, so a table that gives no column changes nothing."""
        of = {
            "txn_id": F.col("l_orderkey"), "line_no": F.col("l_linenumber"), "customer_id": F.col("o_custkey"),
            "prod_id": F.col("l_partkey"), "qty": F.col("l_quantity").cast("int"), "price": _money("p_retailprice"),
            "discount": F.round(F.col("l_discount") * 100).cast("int"), "order_date": F.col("o_orderdate").cast("date"),
            "start_txn_time": F.col("o_orderdate"), "member": F.col("c_mktsegment") == "BUILDING",
        }
        asked = columns or tuple(of)
        df = self.t.lineitem
        if {"customer_id", "order_date", "start_txn_time", "member"} & set(asked):
            df = df.join(self.t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if "price" in asked:
            df = df.join(self.t.part, F.col("l_partkey") == F.col("p_partkey"))
        if "member" in asked:
            df = df.join(self.t.customer, F.col("o_custkey") == F.col("c_custkey"))
        return df.select(*[of[c].alias(c) for c in asked])

    @cached_property
    def v_sales(self) -> DataFrame:
        return self.sales()

    @cached_property
    def v_product(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
            F.col("p_type").alias("segment_name"),
            F.col("p_brand").alias("category_name"),
            F.concat(F.col("p_type"), F.lit("-"), F.floor(F.col("p_size") / 10).cast("string")).alias("bucket"),
            _money("p_retailprice").alias("price"))

    @cached_property
    def v_members(self) -> DataFrame:
        c = self.t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
        o = self.t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderdate")
        first_f = o.groupBy("o_custkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("join_date"))
        return (c.join(first_f, c.c_custkey == first_f.o_custkey)
                .select(F.col("c_custkey").alias("customer_id"), "join_date"))

    # ---- case 2: delivery --------------------------------------------------------------
    @cached_property
    def v_orders_messy(self) -> DataFrame:
        k = F.col("o_orderkey")
        cancelled = F.col("o_orderstatus") == "P"
        tenths = F.round(F.col("o_totalprice") / 1000).cast("bigint")
        km = F.concat(F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."), (tenths % 10).cast("string"))
        return self.t.orders.select(
            k.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (k % 7 + 1).alias("runner_id"),
            _order_time().alias("order_time"),
            F.when(cancelled, None).otherwise(
                F.timestamp_add("MINUTE", k % 40 + 5, _order_time())).alias("pickup_time"),
            F.when(cancelled, F.lit("null"))
             .otherwise(F.concat(km, F.when(k % 2 == 0, F.lit("km")).otherwise(F.lit(" km")))).alias("distance"),
            F.when(cancelled, None)
             .otherwise(F.concat((k % 35 + 10).cast("string"),
                                 F.when(k % 2 == 0, F.lit(" minutes")).otherwise(F.lit("mins")))).alias("duration"),
            F.when(cancelled, F.lit("Customer Cancellation"))
             .when(k % 3 == 0, F.lit("null")).when(k % 3 == 1, F.lit("")).alias("cancellation"))

    def items(self, *columns: str) -> DataFrame:
        """Ordered items with the asked columns (all by default); orders are joined only for theirs."""
        p, s = F.col("l_partkey"), F.col("l_suppkey")
        excl = (F.when(p % 4 == 0, F.lit("null")).when(p % 4 == 1, F.lit(""))
                .when(p % 4 == 2, F.concat((p % 12 + 1).cast("string"), F.lit(", "),
                                           ((p + 5) % 12 + 1).cast("string"))))
        extra = (F.when(s % 4 == 0, F.lit("null")).when(s % 4 == 1, F.lit(""))
                 .when(s % 4 == 2, (s % 12 + 1).cast("string")))
        of = {"order_id": F.col("l_orderkey"), "item_no": F.col("l_linenumber"), "customer_id": F.col("o_custkey"),
              "pizza_id": (p % 3 + 1).cast("int"), "exclusions": excl, "extras": extra, "order_time": _order_time()}
        asked = columns or tuple(of)
        df = self.t.lineitem
        if {"customer_id", "order_time"} & set(asked):
            df = df.join(self.t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return df.select(*[of[c].alias(c) for c in asked])

    @cached_property
    def v_items_messy(self) -> DataFrame:
        return self.items()

    @cached_property
    def v_recipes(self) -> DataFrame:
        return literal_table(self.spark, RECIPES, "pizza_id int, pizza_name string, toppings string")

    @cached_property
    def v_toppings(self) -> DataFrame:
        return literal_table(self.spark, TOPPINGS, "topping_id int, topping_name string")

    @cached_property
    def v_runners(self) -> DataFrame:
        return (self.t.orders.groupBy(F.col("o_custkey").alias("runner_id"))
                .agg(F.min(F.col("o_orderdate").cast("date")).alias("registration_date")))

    @cached_property
    def v_ratings(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.t.orders.select(
            F.when(k % 50 == 0, k - 1).otherwise(k).alias("order_id"),
            (k % 7 + 1).alias("runner_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(k % 97 == 0, None).otherwise(k % 6).cast("int").alias("rating"))

    # ---- case 3: subscriptions -----------------------------------------------------------
    @cached_property
    def v_plan_events(self) -> DataFrame:
        pr = F.col("o_orderpriority")
        return self.t.orders.select(
            F.col("o_custkey").alias("customer_id"),
            (F.substring(pr, 1, 1).cast("int") - 1).alias("plan_id"),
            F.substring(pr, 3, 100).alias("plan_name"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.col("o_orderkey").alias("event_id"),
            _money("o_totalprice").alias("amount"))

    # ---- case 4: bank ----------------------------------------------------------------------
    @cached_property
    def v_nodes(self) -> DataFrame:
        """Customer, region and node of every stay, without its dates."""
        return (self.t.orders.join(self.t.customer, F.col("o_custkey") == F.col("c_custkey"))
                .join(self.t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("o_custkey").alias("customer_id"), F.col("n_regionkey").alias("region_id"),
                        (F.col("o_orderkey") % 5 + 1).alias("node_id")))

    @cached_property
    def v_node_stays(self) -> DataFrame:
        """One stay per order; a stay ends when the customer's next order starts.

        Equivalent to ``lead(start_date)`` over (start_date, order key) per
        customer, without a window over raw rows: per (customer, date) the
        last order key is aggregated, ``lead`` runs over distinct dates only
        (bounded by the calendar), and the result is joined back.  An order
        that is not its day's last ends that same day.
        """
        o = self.t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
        c = self.t.customer.select("c_custkey", "c_nationkey")
        n = self.t.nation.select("n_nationkey", "n_regionkey")
        days = o.groupBy("o_custkey", "d").agg(F.max("o_orderkey").alias("last_key"))
        nxt = days.select("o_custkey", "d", "last_key",
                          F.lead("d").over(Window.partitionBy("o_custkey").orderBy("d")).alias("next_day"))
        end = (F.when(F.col("o_orderkey") < F.col("last_key"), F.col("d"))
               .otherwise(F.coalesce(F.col("next_day"), F.lit(OPEN_END).cast("date"))))
        return (o.join(nxt, ["o_custkey", "d"])
                .join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("o_custkey").alias("customer_id"),
                        F.col("n_regionkey").alias("region_id"),
                        (F.col("o_orderkey") % 5 + 1).alias("node_id"),
                        F.col("d").alias("start_date"),
                        end.alias("end_date")))

    @cached_property
    def v_regions(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))

    @cached_property
    def v_txns_daily(self) -> DataFrame:
        et = F.col("event_type")
        return (self.t.events.filter(et.isin("signup", "purchase", "click"))
                .select(F.col("user_id").alias("customer_id"),
                        F.col("ts").cast("date").alias("txn_date"),
                        F.when(et == "signup", "deposit").when(et == "purchase", "purchase")
                         .otherwise("withdrawal").alias("txn_type"),
                        _money("value").alias("txn_amount")))

    @cached_property
    def v_txns_monthly(self) -> DataFrame:
        st = F.col("o_orderstatus")
        return self.t.orders.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("txn_date"),
            F.when(st == "F", "deposit").when(st == "O", "purchase").otherwise("withdrawal").alias("txn_type"),
            _money("o_totalprice").alias("txn_amount"))

    # ---- case 5: weekly retail -------------------------------------------------------------
    @cached_property
    def v_weekly_raw(self) -> DataFrame:
        o = self.t.orders.select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
        c = self.t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.t.nation.select("n_nationkey", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        seg = F.element_at(F.array(*[F.lit(x) for x in ("C1", "C2", "C3", "F1", "F4", "null")]),
                           (F.col("o_custkey") % 6 + 1).cast("int"))
        week = F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "week"), "d/M/yy")
        return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .groupBy(week.alias("week_date"), F.col("r_name").alias("region"),
                         F.when(F.col("o_orderpriority") < "3", "Shopify").otherwise("Retail").alias("platform"),
                         seg.alias("segment"), F.col("c_mktsegment").alias("customer_type"))
                .agg(F.count(F.lit(1)).cast("int").alias("transactions"),
                     F.sum(_money("o_totalprice")).cast("decimal(18,2)").alias("sales")))

    # ---- case 6: clickstream ---------------------------------------------------------------
    @cached_property
    def v_clicks(self) -> DataFrame:
        e = self.t.events
        visit = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string"))
        et = F.col("event_type")
        code = (F.when(et == "view", 1).when(et == "click", 2).when(et == "purchase", 3)
                .when(et == "signup", 4).when(et == "error", 5))
        return (e.select(visit.alias("visit_id"),
                         F.concat(F.col("user_id").cast("string"), F.lit("-"),
                                  (F.col("event_id") % 3).cast("string")).alias("cookie_id"),
                         (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 13 + 1).alias("page_id"),
                         code.alias("event_type"),
                         F.col("ts").alias("event_time"),
                         "event_id"))

    @cached_property
    def v_users(self) -> DataFrame:
        e = self.t.events
        return (e.groupBy("user_id", F.concat(F.col("user_id").cast("string"), F.lit("-"),
                                             (F.col("event_id") % 3).cast("string")).alias("cookie_id"))
                .agg(F.min("ts").alias("start_date")))

    @cached_property
    def v_pages(self) -> DataFrame:
        return literal_table(self.spark, PAGES,
                             "page_id int, page_name string, product_category string, product_id int")

    @cached_property
    def v_event_identifier(self) -> DataFrame:
        return literal_table(self.spark, EVENT_TYPES, "event_type int, event_name string")

    @cached_property
    def v_campaigns(self) -> DataFrame:
        return (literal_table(self.spark, CAMPAIGNS,
                              "campaign_id int, products string, campaign_name string, s string, e string")
                .select("campaign_id", "products", "campaign_name",
                    F.to_timestamp_ntz(F.col("s")).alias("start_date"),
                    F.to_timestamp_ntz(F.col("e")).alias("end_date")))

    @cached_property
    def v_promotions(self) -> DataFrame:
        """One promotion per supplier: from some day of 1992 to 1998 on, for up to 60 days."""
        start = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("s_suppkey") * 37 % 2400).cast("int"))
        return self.t.supplier.select(
            F.col("s_suppkey").alias("promotion_id"), start.alias("start_date"),
            F.date_add(start, (F.col("s_suppkey") * 11 % 61).cast("int")).alias("end_date"))

    # ---- case 7: hierarchy ---------------------------------------------------------------------
    @cached_property
    def v_hierarchy(self) -> DataFrame:
        r = self.t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"),
                                 F.lit(None).cast("string").alias("parent_id"),
                                 F.lit("Region").alias("level_name"), F.col("r_name").alias("level_text"),
                                 F.lit(None).cast(MONEY).alias("price"))
        n = self.t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
                                 F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                                 F.lit("Nation").alias("level_name"), F.col("n_name").alias("level_text"),
                                 F.lit(None).cast(MONEY).alias("price"))
        s = self.t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"),
                                   F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("parent_id"),
                                   F.lit("Supplier").alias("level_name"), F.col("s_name").alias("level_text"),
                                   _money("s_acctbal").alias("price"))
        return r.unionByName(n).unionByName(s)

    # ---- case 8: interest segments ------------------------------------------------------------------
    def _interest(self, keep: Column | None) -> DataFrame:
        """Monthly interest metrics: composition from revenue, index from quantity; ``keep`` thins the rows."""
        li = self.t.lineitem.select("l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
        p = self.t.part.select("p_partkey", "p_brand", "p_size")
        iid = F.substring("p_brand", 7, 10).cast("int") * 10 + F.col("p_size") % 6
        monthly = (li.join(p, li.l_partkey == p.p_partkey)
                   .groupBy(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"), iid.alias("iid"))
                   .agg(F.sum(_money("l_extendedprice")).alias("rev"), F.sum(F.col("l_quantity").cast("int")).alias("sold")))
        wm = Window.partitionBy("month")
        comp_int = F.round(F.lit(1000000.0) * F.col("rev").cast("double")
                           / F.sum("rev").over(wm).cast("double")).cast("bigint")
        shares = (monthly.withColumn("comp_int", comp_int)
                  .withColumn("index_value", F.round(
                      F.lit(100.0) * (F.col("sold") * F.count(F.lit(1)).over(wm)).cast("double")
                      / F.sum("sold").over(wm).cast("double")) / 100.0)
                  .withColumn("composition", F.col("comp_int") / 10000.0))
        kept = shares if keep is None else shares.filter(keep)
        wr = Window.partitionBy("month").orderBy(F.col("rev").desc(), F.col("iid"))
        ranked = (kept.withColumn("ranking", F.rank().over(wr))
                  .withColumn("n", F.count(F.lit(1)).over(wm)))
        return ranked.select(
            F.when(F.col("iid") % 29 == 0, None).otherwise(F.date_format("month", "MM-yyyy")).alias("month_year"),
            F.col("iid").cast("string").alias("interest_id"),
            "composition", "index_value",
            F.col("ranking").cast("int").alias("ranking"),
            (F.round(F.lit(10000.0) * (1 - (F.col("ranking") - 1).cast("double") / F.col("n").cast("double")))
             / 100.0).alias("percentile_ranking"))

    @cached_property
    def v_interest(self) -> DataFrame:
        return self._interest(None)

    @cached_property
    def v_interest_sparse(self) -> DataFrame:
        """Some interests cover a year or four months only: for the keys that ask about coverage."""
        last = F.col("iid") % 10
        return self._interest((last < 4) | ((last == 4) & (F.year("month") == 1997))
                              | ((last == 5) & F.col("month").between(F.lit("1996-01-01").cast("date"),
                                                                       F.lit("1996-04-01").cast("date"))))

    @cached_property
    def v_interest_map(self) -> DataFrame:
        """Names of the interests that parts have, some left out, and a few of no part, two of them twice."""
        own = self.t.part.select((F.substring("p_brand", 7, 10).cast("int") * 10 + F.col("p_size") % 6).cast("int")
                                 .alias("id")).distinct().filter(F.col("id") % 17 != 0)
        other = self.spark.range(9001, 9008).select(F.least("id", F.lit(9005)).cast("int").alias("id"))
        ids = own.unionByName(other)
        created = F.lit("1996-06-15 00:00:00").cast("timestamp_ntz")
        return ids.select("id",
                          F.concat(F.lit("Interest "), F.col("id").cast("string")).alias("interest_name"),
                          F.concat(F.lit("Summary of interest "), F.col("id").cast("string")).alias("interest_summary"),
                          created.alias("created_at"), created.alias("last_modified"))


def views(spark, root: str) -> Views:
    return Views(Tables(spark, root))
