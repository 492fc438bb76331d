"""The product funnel as a table that is kept up, batch by batch, late rows and all.

A late purchase turns the cart adds of its visit, counted as abandoned so far, into purchases:
the batch that brings it takes them back from one count and adds them to the other.  Three
tables under one folder are only ever appended to, a sub-folder per batch:

* ``carts``  visit_id, page_id, n: the cart adds that the batch brought;
* ``buyers`` visit_id: the visits whose first known purchase the batch brought;
* ``funnel`` page_id, views, cart_adds, abandoned, purchases: what the batch changes, signed.

Batch n reads the sub-folders below n and replaces its own, so a batch that failed half-way, or
is sent again by a stream (``foreachBatch`` gives the number), is simply applied again.
The summary is the sum of the changes, a row per page and batch; ``fold`` sums up old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .funnel import CART_ADD, PAGE_VIEW, PURCHASE

COUNTS = ("views", "cart_adds", "abandoned", "purchases")
SCHEMAS = {"carts": "visit_id string, page_id int, n long", "buyers": "visit_id string",
           "funnel": "page_id int, " + ", ".join(f"{c} long" for c in COUNTS)}
BATCH = "batch"


def read(spark: SparkSession, root: str, table: str, below: int | None = None) -> DataFrame:
    """The rows of ``table`` that batches (those numbered under ``below``) brought; none before the first."""
    path = f"{root.rstrip('/')}/{table}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], f"{SCHEMAS[table]}, {BATCH} long")
    rows = spark.read.schema(f"{SCHEMAS[table]}, {BATCH} long").parquet(path)
    return rows if below is None else rows.filter(F.col(BATCH) < below)


def _write(df: DataFrame, root: str, table: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{table}/{BATCH}={batch}")


def apply(root: str, batch: int, events: DataFrame) -> None:
    """Take in ``events`` (visit_id, page_id, event_type, each event in one batch alone) as number ``batch``.

    Numbers rise from batch to batch; events may come in any order and split.  Visits are matched by key
    joins over (visit, page) counts, never by a visit's list of events.  Events without a visit or page count
    where they can: no visit, no purchase of it; no page, no product."""
    spark, is_ = events.sparkSession, lambda t: F.col("event_type") == t
    known = read(spark, root, "buyers", batch).select("visit_id").distinct()
    bought = events.filter(is_(PURCHASE) & F.col("visit_id").isNotNull()).select(F.col("visit_id").cast("string")).distinct()
    _write(bought.join(known, "visit_id", "left_anti"), root, "buyers", batch)
    adds = (events.filter(is_(CART_ADD)).groupBy(F.col("visit_id").cast("string").alias("visit_id"), F.col("page_id").cast("int").alias("page_id"))
            .agg(F.count(F.lit(1)).alias("n")))
    _write(adds, root, "carts", batch)

    new = read(spark, root, "buyers", batch + 1).filter(F.col(BATCH) == batch).select("visit_id")
    own = read(spark, root, "carts", batch + 1).filter(F.col(BATCH) == batch)
    buyers = known.unionByName(new).withColumn("bought", F.lit(True))
    zero, n = F.lit(0).cast("long"), F.col("n")
    came = own.join(buyers, "visit_id", "left").select(
        "page_id", zero.alias("views"), n.alias("cart_adds"), F.when(F.col("bought"), zero).otherwise(n).alias("abandoned"),
        F.when(F.col("bought"), n).otherwise(zero).alias("purchases"))
    turned = read(spark, root, "carts", batch).join(new, "visit_id", "left_semi").select(
        "page_id", zero.alias("views"), zero.alias("cart_adds"), (-n).alias("abandoned"), n.alias("purchases"))
    views = events.filter(is_(PAGE_VIEW)).groupBy(F.col("page_id").cast("int").alias("page_id")).agg(F.count(F.lit(1)).alias("views"))
    views = views.select("page_id", "views", *[zero.alias(c) for c in COUNTS[1:]])
    changes = came.unionByName(turned).unionByName(views).groupBy("page_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
    _write(changes, root, "funnel", batch)


def fold(spark: SparkSession, root: str, below: int, target: str) -> None:
    """Write the sum of the changes of the batches under ``below`` as one folder ``target`` (same columns)."""
    sums = read(spark, root, "funnel", below).groupBy("page_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
    sums.write.mode("overwrite").parquet(target)


def replay(root: str, events: DataFrame, batches: int, deal) -> None:
    """Take in all ``events`` as ``batches`` batches, dealt by the number that the column ``deal`` gives."""
    for batch in range(batches):
        apply(root, batch, events.filter(deal == batch))


def kept_up_funnel(spark: SparkSession, root: str, pages: DataFrame) -> DataFrame:
    """The product funnel as of the last batch: columns and rows of ``funnel.product_funnel`` over all events."""
    per = read(spark, root, "funnel").groupBy("page_id").agg(*[F.sum(c).alias(c) for c in COUNTS])
    prod = (pages.filter(F.col("product_id").isNotNull())
            .select("page_id", F.col("page_name").alias("product_name"), "product_category"))
    return per.filter("views > 0 or cart_adds > 0").join(prod, "page_id").select("product_name", "product_category", *COUNTS)
