"""Case 7 monthly report: one month's sales → three report tables.

The month is a half-open timestamp range on ``start_txn_time`` (which Spark
pushes into the Parquet scan); the source's ``EXTRACT(MONTH/YEAR)`` equality
is not pushable.  The filtered month is computed once and every output reads
the same plan; when the caller materialises several outputs, Spark reuses the
exchange of the shared aggregate (ReuseExchange) inside one plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_exact, money, pct
from ..operators import basket as B


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + (month == 12), month % 12 + 1, 1)
    return start, end


def sales_in_month(sales: DataFrame, year: int, month: int) -> DataFrame:
    lo, hi = month_bounds(year, month)
    ts = F.col("start_txn_time")
    # wall-clock literals: independent of the session time zone
    lo_ts = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    hi_ts = F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
    return sales.filter((ts >= lo_ts) & (ts < hi_ts))


def monthly_sales_report(sales: DataFrame, year: int, month: int) -> DataFrame:
    m = sales_in_month(sales, year, month)
    return m.agg(F.sum("qty").cast("bigint").alias("total_quantity_sold"),
                 money(F.sum(B.discount_amount())).alias("total_discount_amount"),
                 money(F.sum(B.gross())).alias("total_revenue_before_discount")) \
        .select(F.lit(month).alias("month"), F.lit(year).alias("year"), "*")


def _txt(c):
    """Fixed-scale text of a rounded number (stable across engines)."""
    return c.cast("decimal(18,2)").cast("string")


def monthly_txn_report(sales: DataFrame, year: int, month: int) -> DataFrame:
    """Transaction metrics of the month as (question, answer) text rows.

    The metrics come from one aggregate over the per-transaction table plus
    the distributed exact quartiles (one row each); the single row is turned
    into the six report lines.
    """
    t = B.txn_metrics(sales_in_month(sales, year, month))
    r = F.col("revenue_after_discount")
    mem = F.col("member")
    quartiles = F.broadcast(B.revenue_quartiles(t, "revenue_after_discount"))   # one row
    one = t.agg(
        F.count(F.lit(1)).alias("n"),
        avg_exact("prod_count").alias("avg_prods"),
        avg_exact("total_discount").alias("avg_disc"),
        pct(F.count_if(mem), F.count(F.lit(1))).alias("pct_m"),
        pct(F.count_if(~mem), F.count(F.lit(1))).alias("pct_n"),
        avg_exact(F.when(mem, r)).alias("rev_m"),
        avg_exact(F.when(~mem, r)).alias("rev_n")).crossJoin(quartiles)
    lines = [
        ("Total unique transactions", F.col("n").cast("string")),
        ("Average unique products per txn", _txt(F.col("avg_prods"))),
        ("Revenue Percentiles (25th, 50th, 75th)",
         F.concat_ws(", ", _txt(F.col("p25")), _txt(F.col("p50")), _txt(F.col("p75")))),
        ("Average discount value per txn", _txt(F.col("avg_disc"))),
        ("Member vs Non-Member split (%)",
         F.concat(_txt(F.col("pct_m")), F.lit("% vs "), _txt(F.col("pct_n")), F.lit("%"))),
        ("Average Revenue: Member vs Non-Member", F.concat(_txt(F.col("rev_m")), F.lit(" vs "), _txt(F.col("rev_n")))),
    ]
    rows = one.select(F.array(*[F.struct(F.lit(q).alias("question"), a.alias("answer")) for q, a in lines]).alias("rows"))
    return rows.select(F.inline("rows"))


PRODUCT_TABLES = {
    "top_products": B.top_products_by_revenue,
    "segment_totals": B.segment_totals,
    "top_product_per_segment": B.top_product_per_segment,
    "category_totals": B.category_totals,
    "top_product_per_category": B.top_product_per_category,
    "product_share_in_segment": B.product_share_in_segment,
    "segment_share_in_category": B.segment_share_in_category,
    "category_share": B.category_share,
    "product_penetration": B.product_penetration,
    "top_product_triple": B.top_product_triple,
}


def monthly_product_report(sales: DataFrame, product: DataFrame, year: int, month: int) -> dict[str, DataFrame]:
    """The ten product tables of the month, all fed the same filtered plan."""
    m = sales_in_month(sales, year, month)
    return {name: fn(m, product) for name, fn in PRODUCT_TABLES.items()}


def monthly_report(sales: DataFrame, product: DataFrame, year: int, month: int) -> dict[str, DataFrame]:
    out = {"sales_analysis": monthly_sales_report(sales, year, month),
           "transaction_analysis": monthly_txn_report(sales, year, month)}
    out.update({f"product_analysis_{k}": v for k, v in monthly_product_report(sales, product, year, month).items()})
    return out


def run_monthly_report(sales: DataFrame, product: DataFrame, year: int, month: int, out_root: str) -> None:
    """The whole monthly report job: the month's sales are filtered once and
    materialised (12 outputs read them), then every table is written under
    ``out_root/<table>`` — replacing the previous run's tables."""
    from .sinks import materialize, write_tables
    month_sales = materialize(sales_in_month(sales, year, month), f"sales_{year}_{month:02d}")
    write_tables(monthly_report(month_sales, product, year, month), out_root)
