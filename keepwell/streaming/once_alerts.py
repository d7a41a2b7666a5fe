"""One alert per customer and period, however many negative reviews arrive and however often the stream restarts."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# the processor travels with its code, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELAY = "31 days"
PERIODS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


class FirstOfPeriod(StatefulProcessor):
    """Per customer: the periods alerted already, each kept until the watermark has passed its end."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle) -> None:
        self.handle, self.alerted = handle, handle.getMapState("alerted", "period_end long", "review_id string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The review with the lowest rating, then the smallest id, speaks for its period in a batch. Only one row per period is held."""
        best: dict[int, tuple] = {}
        for batch in rows:
            first = batch.sort_values(["rating", "review_id"], na_position="last").groupby("period_end", sort=False).head(1)
            for row in first[["period_end", *self.columns]].itertuples(index=False, name=None):
                held = best.get(row[0])
                if held is None or self._order(row[1:]) < self._order(held):
                    best[row[0]] = row[1:]
        fresh = [(end, row) for end, row in sorted(best.items()) if not self.alerted.containsKey((end,))]
        for end, row in fresh:
            self.alerted.updateValue((end,), (row[self.columns.index("review_id")],))
            self.handle.registerTimer(end)
        if fresh:
            yield pd.DataFrame([row for _, row in fresh], columns=self.columns)

    def _order(self, row: tuple) -> tuple:
        rating, review = (row[self.columns.index(c)] for c in ("rating", "review_id"))
        return (1, 0, review) if pd.isna(rating) else (0, rating, review)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alerted.removeKey((expiredTimerInfo.getExpiryTimeInMs(),))
        return iter(())

    def close(self) -> None:
        pass


def once(found: DataFrame, period: str = "day", delay: str = DELAY) -> DataFrame:
    """Streaming alert rows (`alerts.alerts`) -> the first of each customer and calendar `period`, one of PERIODS.

    Within a batch the lowest rating speaks for the period, then the smallest review id; a batch that comes after it adds none.
    A review dated more than `delay` before the newest one of earlier batches is late: it raises no alert, the state's metrics
    count it (`late_rows`), and the nightly reports have it as they have all reviews. Reviews without a day or without a customer
    belong to no period and raise none. State is bounded by the periods that `delay` leaves open, per watched customer.
    """
    columns = found.columns
    end = F.unix_millis(F.date_trunc(period, "_day") + F.expr(f"interval {PERIODS[period]}"))
    dated = found.where("review_date is not null and customer_id is not null").withColumn("_day", F.col("review_date").cast("timestamp"))
    rows = dated.withWatermark("_day", delay).withColumn("period_end", end)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return rows.groupBy("customer_id").transformWithStateInPandas(FirstOfPeriod(columns), kinds, "Append", "EventTime")


def run(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the alerts of everything new and wait for it. The state needs the RocksDB store, which is set for this query only."""
    conf = rows.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKSDB)
    try:  # a query takes the session's settings when it starts
        query = (rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                 .outputMode("append").trigger(availableNow=True).start())
    finally:
        conf.set(STORE, before) if before else conf.unset(STORE)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """How many reviews of a run came too late."""
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"])
