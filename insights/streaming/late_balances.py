"""Real-time allocation over a stream whose rows come late and out of order.

``transformWithState`` keeps, per customer,

* ``open``: for each day the watermark has not passed, the day's transactions in order, their
  sum and the highest balance the day reaches over its opening balance;
* ``closed``: what all earlier days come to: a balance, and the highest balance of the month
  they end in.

A row that comes late goes into its day, in its place; the days after it move by its amount, and
the month maxima that change are sent again (the latest batch of a (customer, month) holds).
When the watermark passes the end of a day, a timer folds the day into ``closed`` and drops its
rows: the state of a customer holds the days within the allowed lateness and four numbers.
Rows of days already folded are dropped by Spark at the watermark; should one still come,
it joins the balance, not the maxima of months gone by.

Needs the RocksDB state store (``STATE_STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .balances import OUT_SCHEMA, transactions

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DAY_MS = 86_400_000
DAY_SCHEMA = "us array<long>, id array<long>, cents array<long>, month string, total long, top long"
CLOSED_SCHEMA = "balance long, month string, most long, day int"


class Balances(StatefulProcessor):
    """Per customer: rows in any order in, (customer, month, highest balance) out whenever it changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "day int", DAY_SCHEMA)
        self.closed = handle.getValueState("closed", CLOSED_SCHEMA)

    def _closed(self) -> tuple[int, str | None, int | None, int | None]:
        return tuple(self.closed.get()) if self.closed.exists() else (0, None, None, None)

    def _days(self) -> list[tuple[int, tuple]]:
        return sorted((k[0], tuple(v)) for k, v in self.open.iterator())

    def _maxima(self, days: list[tuple[int, tuple]]) -> dict[str, int]:
        """Highest balance of every month that open days, or the last closed one, belong to."""
        balance, month, most, _ = self._closed()
        out = {month: most} if month is not None else {}
        for _, (_, _, _, m, total, top) in days:
            out[m] = max(out.get(m, balance + top), balance + top)
            balance += total
        return out

    def _fold(self, watermark_ms: int) -> None:
        """Days that end before the watermark become part of the closed balance."""
        balance, month, most, last = self._closed()
        for day, (_, _, _, m, total, top) in self._days():
            if (day + 1) * DAY_MS > watermark_ms:
                break
            most = max(most, balance + top) if m == month else balance + top
            balance, month, last = balance + total, m, day
            self.open.removeKey((day,))
            self.closed.update((balance, month, most, last))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self._maxima(self._days())
        balance, month, most, last = self._closed()
        for pdf in rows:
            for day, part in pdf.groupby("day"):
                day = int(day)
                if last is not None and day <= last:
                    balance += int(part["cents"].sum())
                    self.closed.update((balance, month, most, last))
                    continue
                held = self.open.getValue((day,)) if self.open.containsKey((day,)) else ([], [], [])
                us, number, cents = (np.concatenate([np.array(h, dtype=np.int64), part[c].to_numpy(np.int64)])
                                     for h, c in zip(held[:3], ("us", "event_id", "cents"), strict=True))
                order = np.lexsort([number, us])
                running = np.cumsum(cents[order])
                self.open.updateValue((day,), (us[order].tolist(), number[order].tolist(), cents[order].tolist(),
                                               str(part["month"].iloc[0]), int(running[-1]), int(running.max())))
                self.handle.registerTimer((day + 1) * DAY_MS)
        after = self._maxima(self._days())
        changed = {m: v for m, v in after.items() if before.get(m) != v}
        if changed:
            yield pd.DataFrame({"customer_id": np.full(len(changed), key[0], dtype=np.int64), "month": list(changed),
                                "max_balance_cents": np.array(list(changed.values()), dtype=np.int64)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._fold(expiredTimerInfo.getExpiryTimeInMs())
        return iter(())

    def close(self) -> None:
        pass


def late_monthly_max(events: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Streaming (customer_id, month, max_balance_cents) updates; rows may come ``lateness`` behind the latest.

    Rows without customer or time are left out; rows that repeat count each."""
    t = transactions(events).filter(F.col("customer_id").isNotNull() & F.col("ts").isNotNull())
    keyed = t.select("customer_id", F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).alias("day"),
                     F.date_format("ts", "yyyy-MM").alias("month"), F.expr("unix_micros(cast(ts as timestamp))").alias("us"),
                     "event_id", "cents", F.expr("timestamp_millis(unix_millis(cast(ts as timestamp)))").alias("event_time"))
    return (keyed.withWatermark("event_time", lateness).groupBy("customer_id")
            .transformWithStateInPandas(Balances(), OUT_SCHEMA, "update", "eventTime"))
