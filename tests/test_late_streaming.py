"""The real-time allocation over a stream that comes late and out of order, against a batch computation."""

import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from insights.streaming import balances as SB
from insights.streaming import late_balances as LB

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def store(spark):
    for k, v in LB.STATE_STORE.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    for k in LB.STATE_STORE:
        spark.conf.unset(k)


def run(spark, pieces, lateness):
    """Stream the pieces, a micro-batch each; the monthly allocation, and the folder of the checkpoint."""
    root = tempfile.mkdtemp(prefix="insights-late-")
    for k, piece in enumerate(pieces):
        piece.coalesce(1).write.parquet(f"{root}/in/{k:02d}")
        for f in os.listdir(f"{root}/in/{k:02d}"):
            if f.endswith(".parquet"):
                os.makedirs(f"{root}/all", exist_ok=True)
                os.rename(f"{root}/in/{k:02d}/{f}", f"{root}/all/{k:02d}.parquet")
                os.utime(f"{root}/all/{k:02d}.parquet", (1_600_000_000 + 10 * k,) * 2)
    stream = SB.read_events_stream(spark, f"{root}/all", max_files_per_trigger=1)
    SB.start_to_table(LB.late_monthly_max(stream, lateness), f"{root}/out", f"{root}/ckpt").awaitTermination(300)
    out = SB.monthly_allocation(spark.read.parquet(f"{root}/out"))
    return sorted(map(tuple, out.collect())), f"{root}/ckpt"


def batch(events):
    t = SB.transactions(events)
    w = Window.partitionBy("customer_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    per = (t.withColumn("bal", F.sum("cents").over(w))
           .groupBy("customer_id", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.max("bal").alias("c")))
    out = per.groupBy("month").agg((F.sum("c") / F.lit(100)).cast("decimal(18,2)").alias("total_allocation"))
    return sorted(map(tuple, out.collect()))


@pytest.fixture(scope="module")
def events(spark):
    """Four months of transactions: the given ones, spread over time."""
    e = spark.read.parquet(EVENTS).filter("event_type in ('signup', 'purchase', 'click')")
    return e.withColumn("ts", F.expr("ts + make_dt_interval(event_id % 4 * 30)")).select(*spark.read.parquet(EVENTS).columns)


def test_shuffled_arrival_gives_the_batch_result(spark, store, events):
    pieces = [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k) for k in range(4)]
    got, _ = run(spark, pieces, "400 days")
    assert len(got) >= 4 and got == batch(events)


def test_state_holds_the_open_days_only(spark, store, events):
    """Rows up to two days late: the batch result, and no day in state that the watermark passed long ago."""
    late = F.expr("ts + make_dt_interval(event_id % 3)")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 6
    pieces = [events.filter((late >= lo + k * step) & (late < lo + (k + 1) * step if k < 5 else F.lit(True))) for k in range(6)]
    got, ckpt = run(spark, pieces, "3 days")
    assert got == batch(events)
    days = spark.read.format("statestore").option("stateVarName", "open").load(ckpt).select("key.customer_id", "user_map_key.day")
    newest = (hi.date() - __import__("datetime").date(1970, 1, 1)).days
    all_days = SB.transactions(events).select("customer_id", F.to_date("ts")).distinct().count()
    # the last micro-batch and the lateness before it
    assert days.agg(F.min("day")).first()[0] >= newest - step.days * 2 - 5
    assert days.count() < all_days / 2
