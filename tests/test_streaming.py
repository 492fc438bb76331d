"""The streaming real-time allocation against a batch computation of the same quantity."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from insights.streaming import balances as SB

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="insights-stream-")
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = SB.read_events_stream(spark, "/root/testdata/sf0.001", "events.parquet")
    q = SB.start_to_table(SB.realtime_monthly_max(stream), out, ckpt)
    q.awaitTermination(300)
    got = SB.monthly_allocation(spark.read.parquet(out))

    # batch: running balance after every transaction, max per (customer, month)
    t = SB.transactions(spark.read.parquet(EVENTS))
    w = Window.partitionBy("customer_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    per = (t.withColumn("bal", F.sum("cents").over(w))
           .groupBy("customer_id", F.date_format("ts", "yyyy-MM").alias("month")).agg(F.max("bal").alias("c")))
    want = per.groupBy("month").agg((F.sum("c") / F.lit(100)).cast("decimal(18,2)").alias("total_allocation"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() >= 1
