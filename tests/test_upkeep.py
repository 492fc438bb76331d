"""The kept-up funnel against one run over all events, for any split and order of the events."""

import random

import pytest
from pyspark.sql import functions as F

from insights.operators import funnel as FN
from insights.operators import upkeep as U

PAGES = "page_id int, page_name string, product_category string, product_id int"


def events(n=900, visits=60):
    rng = random.Random(n)
    return [(f"v{rng.randint(0, visits)}" if rng.random() > 0.02 else None, rng.randint(1, 6),
             rng.choices([FN.PAGE_VIEW, FN.CART_ADD, FN.PURCHASE, FN.AD_CLICK], [6, 5, 1, 1])[0]) for _ in range(n)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(p, f"page {p}", "x", p if p < 6 else None) for p in range(1, 7)], PAGES)


def frame(spark, rows):
    return spark.createDataFrame(rows, "visit_id string, page_id int, event_type int")


def table(df):
    return sorted(map(tuple, df.select("product_name", *U.COUNTS).collect()))


@pytest.mark.parametrize("cuts", [[], [450], [10, 20, 700], [0, 300, 300]])
def test_any_split_gives_the_table_of_one_run(spark, pages, tmp_path, cuts):
    rows = events()
    random.Random(len(cuts)).shuffle(rows)  # late purchases and late cart adds
    bounds = [0, *cuts, len(rows)]
    for batch, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        U.apply(str(tmp_path), batch, frame(spark, rows[lo:hi]))
        if batch in (0, 1):
            assert table(U.kept_up_funnel(spark, str(tmp_path), pages)) == table(FN.product_funnel(frame(spark, rows[:hi]), pages))
    assert table(U.kept_up_funnel(spark, str(tmp_path), pages)) == table(FN.product_funnel(frame(spark, rows), pages))


def test_a_late_purchase_takes_back_the_abandoned_adds(spark, pages, tmp_path):
    U.apply(str(tmp_path), 0, frame(spark, [("a", 1, FN.CART_ADD), ("a", 1, FN.CART_ADD), ("b", 1, FN.CART_ADD)]))
    assert table(U.kept_up_funnel(spark, str(tmp_path), pages)) == [("page 1", 0, 3, 3, 0)]
    U.apply(str(tmp_path), 1, frame(spark, [("a", 6, FN.PURCHASE)]))
    U.apply(str(tmp_path), 2, frame(spark, [("a", 6, FN.PURCHASE), ("a", 2, FN.CART_ADD)]))
    assert table(U.kept_up_funnel(spark, str(tmp_path), pages)) == [("page 1", 0, 3, 1, 2), ("page 2", 0, 1, 0, 1)]
    changes = U.read(spark, str(tmp_path), "funnel").filter("batch = 1").select(*U.COUNTS).collect()
    assert [tuple(r) for r in changes] == [(0, 0, -2, 2)]


def test_a_batch_sent_again_counts_once(spark, pages, tmp_path):
    rows = events(200)
    for batch in (0, 1, 1, 2, 2):
        U.apply(str(tmp_path), batch, frame(spark, rows[batch * 70:(batch + 1) * 70]))
    assert table(U.kept_up_funnel(spark, str(tmp_path), pages)) == table(FN.product_funnel(frame(spark, rows), pages))
    U.fold(spark, str(tmp_path), 3, str(tmp_path / "folded"))
    folded = spark.read.parquet(str(tmp_path / "folded")).agg(F.sum("cart_adds")).first()[0]
    assert folded == sum(t == FN.CART_ADD for _, _, t in rows)


def test_nothing(spark, pages, tmp_path):
    assert U.kept_up_funnel(spark, str(tmp_path / "none"), pages).collect() == []
    U.apply(str(tmp_path), 0, frame(spark, []))
    assert U.kept_up_funnel(spark, str(tmp_path), pages).collect() == []


def test_as_the_sink_of_a_stream(spark, pages, tmp_path):
    rows, source, root = events(300), str(tmp_path / "in"), str(tmp_path / "kept")
    for k in range(3):
        frame(spark, rows[k * 100:(k + 1) * 100]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("visit_id string, page_id int, event_type int").option("maxFilesPerTrigger", 1).parquet(source)
    query = (stream.writeStream.foreachBatch(lambda df, n: U.apply(root, n, df))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination(150)
    assert U.read(spark, root, "funnel").select("batch").distinct().count() == 3
    assert table(U.kept_up_funnel(spark, root, pages)) == table(FN.product_funnel(frame(spark, rows), pages))
