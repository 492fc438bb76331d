"""Real-time balance allocation (case 4, option 3) as a Structured Streaming job.

Transactions arrive as a stream; each customer's running balance is kept in
state and the job emits, per (customer, month), the highest balance reached
after any transaction of that month — the storage a real-time allocation
would have to provision.  Monthly totals are a plain aggregate over the
emitted table.

The stateful step is ``applyInPandasWithState`` keyed by customer (Spark
partitions and shuffles the keys; the per-group work is a vectorised numpy
cumulative sum).  Amounts are integer cents, so balances are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
OUT_SCHEMA = "customer_id long, month string, max_balance_cents long"
STATE_SCHEMA = "balance long, month string, month_max long"


def transactions(events: DataFrame) -> DataFrame:
    """Signed transaction amounts (cents) from the event stream (same mapping as the batch view)."""
    et = F.col("event_type")
    amount = F.round(F.col("value").cast("decimal(12,2)") * 100).cast("bigint")
    return (events.filter(et.isin("signup", "purchase", "click"))
            .select(F.col("user_id").alias("customer_id"), "ts", "event_id",
                    F.when(et == "signup", amount).otherwise(-amount).alias("cents")))


def _update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "event_id"])
    if state.exists:
        balance, cur_month, cur_max = state.get
    else:
        balance, cur_month, cur_max = 0, None, None
    running = balance + np.cumsum(pdf["cents"].to_numpy(dtype=np.int64))
    months = pd.to_datetime(pdf["ts"]).dt.strftime("%Y-%m").to_numpy()
    per_month = pd.Series(running).groupby(months, sort=True).max()
    if cur_month is not None and cur_month in per_month.index:
        per_month[cur_month] = max(int(per_month[cur_month]), int(cur_max))
    last_month = per_month.index[-1]
    state.update((int(running[-1]), str(last_month), int(per_month[last_month])))
    yield pd.DataFrame({"customer_id": np.full(len(per_month), key[0], dtype=np.int64),
                        "month": per_month.index.astype(str),
                        "max_balance_cents": per_month.to_numpy(dtype=np.int64)})


def realtime_monthly_max(events: DataFrame) -> DataFrame:
    """Streaming DataFrame of (customer_id, month, max_balance_cents) updates.

    Events of one customer must arrive in time order across micro-batches
    (within a batch they are sorted); a later row for the same
    (customer, month) supersedes an earlier one.
    """
    return (transactions(events).groupBy("customer_id")
            .applyInPandasWithState(_update, OUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout))


def read_events_stream(spark: SparkSession, directory: str, file_glob: str = "*.parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files of ``directory`` matching ``file_glob`` as they arrive."""
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def start_to_table(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append every micro-batch's updates (tagged with the batch id) to a Parquet table.

    The latest batch per (customer, month) is the current value; see
    ``monthly_allocation``.  ``checkpoint`` should live under the shared
    ``spark.checkpoint.dir`` so a restarted driver resumes exactly.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    w = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def monthly_allocation(updates: DataFrame) -> DataFrame:
    """Per month, the sum over customers of their latest max balance (in currency units)."""
    latest = updates.groupBy("customer_id", "month").agg(
        F.max_by("max_balance_cents", "batch_id").alias("c"))
    return latest.groupBy("month").agg((F.sum("c") / F.lit(100)).cast("decimal(18,2)").alias("total_allocation"))
