"""Case 7 — apparel sales: high-level, transaction and product analysis.

Inputs: ``sales`` (txn_id, prod_id, qty, price, discount %, member,
start_txn_time), ``product`` (product_id, product_name, segment_name,
category_name, bucket).  Revenue arithmetic is exact decimal; "net" revenue
really applies the discount (integer division in the source dialect would
drop it).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_exact, money, pct, round_double
from .combinations import combinations
from .hierarchy import ancestry
from .patterns import share_of_total, top_k, top_k_per_group
from .selection import exact_quantiles

def _cent():
    return F.lit(Decimal("0.01"))


def gross():
    return F.col("qty") * F.col("price")


def discount_amount():
    return F.col("qty") * F.col("price") * F.col("discount") * _cent()


def net():
    return F.col("qty") * F.col("price") * (F.lit(100) - F.col("discount")) * _cent()


# ---- high level ------------------------------------------------------------------------
def total_quantity(sales: DataFrame) -> DataFrame:
    return sales.agg(F.sum("qty").cast("bigint").alias("total_quantity"))


def gross_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(money(F.sum(gross())).alias("total_revenue_before_discount"))


def total_discount(sales: DataFrame) -> DataFrame:
    return sales.agg(money(F.sum(discount_amount())).alias("total_discount_amount"))


# ---- transactions ----------------------------------------------------------------------
def unique_transactions(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("txn_id").alias("total_unique_transactions"))


def txn_metrics(sales: DataFrame) -> DataFrame:
    """One row per transaction: member, distinct products, net revenue, discount."""
    return sales.groupBy("txn_id", "member").agg(
        F.countDistinct("prod_id").alias("prod_count"),
        F.sum(net()).alias("revenue_after_discount"),
        F.sum(discount_amount()).alias("total_discount"))


def avg_unique_products_per_txn(sales: DataFrame) -> DataFrame:
    per_txn = sales.groupBy("txn_id").agg(F.countDistinct("prod_id").alias("n"))
    return per_txn.agg(avg_exact("n").alias("avg_unique_products_per_transaction"))


def txn_revenue_percentiles(sales: DataFrame) -> DataFrame:
    """p25/p50/p75 of net revenue per transaction (exact ``percentile_cont``)."""
    per_txn = sales.groupBy("txn_id").agg(F.sum(net()).alias("r"))
    return revenue_quartiles(per_txn, "r")


QUARTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))


def revenue_quartiles(per_txn: DataFrame, col: str, scale: int = 10000) -> DataFrame:
    """p25/p50/p75 of an exact money column, rounded to cents (one row)."""
    scaled = per_txn.select((F.col(col) * scale).cast("bigint").alias("s"))
    q = exact_quantiles(scaled, "s", [p for p, _ in QUARTILES], [n for _, n in QUARTILES])
    return q.select(*[round_double(F.col(n) / F.lit(float(scale))).alias(n) for _, n in QUARTILES])


def avg_discount_per_txn(sales: DataFrame) -> DataFrame:
    per_txn = sales.groupBy("txn_id").agg(F.sum(discount_amount()).alias("d"))
    return per_txn.agg(avg_exact("d").alias("avg_total_discount_per_transaction"))


def member_txn_split(sales: DataFrame) -> DataFrame:
    counts = sales.groupBy("member").agg(F.countDistinct("txn_id").alias("txn_count"))
    return share_of_total(counts, "txn_count", "percentage")


def avg_revenue_by_member(sales: DataFrame) -> DataFrame:
    per_txn = sales.groupBy("member", "txn_id").agg(F.sum(net()).alias("r"))
    return per_txn.groupBy("member").agg(avg_exact("r").alias("avg_revenue"))


# ---- products ---------------------------------------------------------------------------
def _per_product(sales: DataFrame) -> DataFrame:
    """Aggregate the fact table to products *before* joining the dimension."""
    return sales.groupBy("prod_id").agg(
        F.sum("qty").alias("qty"), F.sum(gross()).alias("gross"),
        F.sum(net()).alias("net"), F.sum(discount_amount()).alias("disc"))


def top_products_by_revenue(sales: DataFrame, product: DataFrame, k: int = 3) -> DataFrame:
    pp = _per_product(sales)
    best = top_k(pp, [F.col("gross").desc(), F.col("prod_id")], k)
    return (best.join(product, best.prod_id == product.product_id)
            .select("product_id", "product_name",
                    money(F.col("gross")).alias("total_revenue_before_discount")))


def _totals_by(sales: DataFrame, product: DataFrame, level: str) -> DataFrame:
    pp = _per_product(sales).join(product.select("product_id", level), F.col("prod_id") == F.col("product_id"))
    return pp.groupBy(level).agg(
        F.sum("qty").cast("bigint").alias("total_quantity"),
        money(F.sum("net")).alias("revenue_after_discount"),
        money(F.sum("disc")).alias("total_discount_amount"))


def segment_totals(sales: DataFrame, product: DataFrame) -> DataFrame:
    return _totals_by(sales, product, "segment_name")


def category_totals(sales: DataFrame, product: DataFrame) -> DataFrame:
    return _totals_by(sales, product, "category_name")


def _top_product_by(sales: DataFrame, product: DataFrame, level: str) -> DataFrame:
    pp = (sales.groupBy("prod_id").agg(F.sum("qty").cast("bigint").alias("total_quantity"))
          .join(product.select("product_id", "product_name", level), F.col("prod_id") == F.col("product_id")))
    best = top_k_per_group(pp, level, [F.col("total_quantity").desc()], 1, ties=True)
    return best.select(level, "product_name", "total_quantity")


def top_product_per_segment(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Best-selling product(s) by quantity in each segment, ties kept."""
    return _top_product_by(sales, product, "segment_name")


def top_product_per_category(sales: DataFrame, product: DataFrame) -> DataFrame:
    return _top_product_by(sales, product, "category_name")


def _net_by(sales: DataFrame, product: DataFrame, levels: list[str]) -> DataFrame:
    pp = _per_product(sales).join(product.select("product_id", *levels), F.col("prod_id") == F.col("product_id"))
    return pp.groupBy(*levels).agg(F.sum("net").alias("net"))


def product_share_in_segment(sales: DataFrame, product: DataFrame) -> DataFrame:
    g = _net_by(sales, product, ["segment_name", "product_name"])
    return (share_of_total(g, "net", "pct_of_segment_revenue", group="segment_name")
            .select("segment_name", "product_name", money(F.col("net")).alias("revenue_after_discount"),
                    "pct_of_segment_revenue"))


def segment_share_in_category(sales: DataFrame, product: DataFrame) -> DataFrame:
    g = _net_by(sales, product, ["category_name", "segment_name"])
    return (share_of_total(g, "net", "pct_of_category_revenue", group="category_name")
            .select("segment_name", "category_name", money(F.col("net")).alias("revenue_after_discount"),
                    "pct_of_category_revenue"))


def category_share(sales: DataFrame, product: DataFrame) -> DataFrame:
    g = _net_by(sales, product, ["category_name"])
    return (share_of_total(g, "net", "pct_of_total_revenue")
            .select("category_name", money(F.col("net")).alias("revenue_after_discount"), "pct_of_total_revenue"))


def product_penetration(sales: DataFrame, product: DataFrame) -> DataFrame:
    """% of all transactions that contain each product.

    Each sale counts for its product and once for all products (no product id), so the transactions are
    counted in the same pass; Spark runs the shuffle of the counts once for both sides.
    """
    of = F.explode(F.array(F.col("prod_id"), F.lit(None)))
    pairs = sales.filter(F.col("txn_id").isNotNull()).select("txn_id", of.alias("prod_id")).distinct()
    counts = pairs.groupBy("prod_id").agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.max(F.when(F.col("prod_id").isNull(), F.col("n"))).alias("total")))  # one row
    # compared null-safe: a plain equality would filter one side's sales before the counts are shared
    named = product.filter(F.col("product_id").isNotNull()).select("product_id", "product_name")
    return (counts.crossJoin(total).join(named, F.col("prod_id").eqNullSafe(F.col("product_id")))
            .select("product_id", "product_name", pct(F.col("n"), F.col("total")).alias("penetration_percentage")))


def top_product_sets(sales: DataFrame, product: DataFrame, size: int, k: int = 1) -> DataFrame:
    """The ``k`` most frequent combinations of ``size`` different products in one transaction (ties: smallest
    ids), counted level by level with an exact bound; the few winners get their names at the end."""
    best = combinations(sales, "txn_id", "prod_id", size, k).best
    for n in range(1, size + 1):
        named = product.select(F.col("product_id").alias(f"p{n}"), F.col("product_name").alias(f"product_{n}"))
        best = best.join(named, f"p{n}")
    return best.select(*[f"product_{n}" for n in range(1, size + 1)], F.col("n").alias("combination_count"))


def top_product_triple(sales: DataFrame, product: DataFrame, k: int = 1) -> DataFrame:
    """Most frequent combination of 3 different products in one transaction."""
    return top_product_sets(sales, product, 3, k)


def flatten_hierarchy(hierarchy: DataFrame) -> DataFrame:
    """Three-level parent/child hierarchy → one row per leaf with its ancestors.

    Depth is fixed (region → nation → supplier), so two equi-joins replace a
    recursive CTE; both joins go to the small upper levels.
    """
    leaf = hierarchy.filter(F.col("level_name") == "Supplier").alias("l")
    mid = hierarchy.filter(F.col("level_name") == "Nation").alias("m")
    top = hierarchy.filter(F.col("level_name") == "Region").alias("t")
    return (leaf.join(mid, F.col("l.parent_id") == F.col("m.id"))
            .join(top, F.col("m.parent_id") == F.col("t.id"))
            .select(F.col("l.id").alias("product_id"), F.col("l.price").alias("price"),
                    F.concat_ws(" ", F.col("l.level_text"), F.col("m.level_text"), F.lit("-"),
                                F.col("t.level_text")).alias("product_name"),
                    F.col("t.id").alias("category_id"), F.col("m.id").alias("segment_id"),
                    F.col("l.id").alias("style_id"),
                    F.col("t.level_text").alias("category_name"), F.col("m.level_text").alias("segment_name"),
                    F.col("l.level_text").alias("style_name")))


def hierarchy_paths(hierarchy: DataFrame) -> DataFrame:
    """Root, depth and path of every node of a hierarchy of any depth; orphans and circles are named."""
    return ancestry(hierarchy).select("id", "root", "depth", "status", F.concat_ws("/", "path").alias("path"))
