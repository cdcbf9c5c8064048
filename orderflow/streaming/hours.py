"""Hourly totals under a lateness bound, with exact correction.

A watermark of ``delay`` behind the newest event bounds the state: it holds the hours that are still open.  When the
watermark passes an hour's end a timer closes it and its total is written once.  Rows that come after that are late: their
sums are written as deltas of the closed hour, to a side table.  Closed totals, late deltas and the open hours of the state
add up to the batch result whatever the order of arrival, and every row is in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderflow.session import prepare_processors
from orderflow.streaming import jobs as J

HOUR_MS = 3_600_000
TOTAL = T.StructType([T.StructField("orders", T.LongType()), T.StructField("cents", T.DecimalType(38, 0))])
OUT = T.StructType([T.StructField("hourStart", T.LongType()), T.StructField("kind", T.StringType()), *TOTAL.fields])
_LOW = 30


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums by hour of the batches of a task; amounts in two parts, so that no sum leaves 64 bits."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        hours, at = np.unique(batch["hourStart"].to_numpy(np.int64), return_inverse=True)
        cents = batch["cents"].to_numpy(np.int64)
        parts = [np.bincount(at, minlength=len(hours))]
        for part in (cents >> _LOW, cents & ((1 << _LOW) - 1)):
            added = np.zeros(len(hours), np.int64)
            np.add.at(added, at, part)
            parts.append(added)
        for hour, n, high, low in zip(hours.tolist(), *(p.tolist() for p in parts), strict=True):
            held = total.setdefault(hour, [0, 0])
            held[0] += n
            held[1] += (high << _LOW) + low
    if total:
        yield pd.DataFrame({"hourStart": list(total), "orders": [n for n, _ in total.values()],
                            "cents": [Decimal(c) for _, c in total.values()]})


class OpenHours(StatefulProcessor):
    """One state row for each open hour."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._total = handle.getValueState("total", TOTAL)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        orders, cents = 0, Decimal(0)
        for row in rows:
            orders, cents = orders + row["orders"], cents + row["cents"]
        end = key[0] + HOUR_MS
        held = self._total.get()
        if held is None and end <= timerValues.getCurrentWatermarkInMs():
            yield Row(hourStart=key[0], kind="late", orders=orders, cents=cents)
            return
        if held is None:
            self._handle.registerTimer(end)
        else:
            orders, cents = orders + held[0], cents + held[1]
        self._total.update((orders, cents))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        orders, cents = self._total.get()
        self._total.clear()
        yield Row(hourStart=key[0], kind="closed", orders=orders, cents=cents)

    def close(self) -> None:
        pass


def hours_with_late(orders: DataFrame, ts_col: str = "createdAt", delay: str = "1 hour") -> DataFrame:
    """Of a stream of orders: totals of hours as they close, and deltas of hours that were closed before (``kind``)."""
    prepare_processors(orders.sparkSession, __name__)
    ts = F.col(ts_col).cast("timestamp")
    seen = orders.withColumn("_ts", ts).where("_ts is not null").withWatermark("_ts", delay).select(
        F.unix_millis(F.date_trunc("hour", F.col("_ts"))).alias("hourStart"),
        F.coalesce((F.col("totalAmount") * 100).cast("long"), F.lit(0)).alias("cents"))
    summed = seen.mapInPandas(_summed, "hourStart long, orders long, cents decimal(38,0)")
    return summed.groupBy("hourStart").transformWithState(
        statefulProcessor=OpenHours(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


@dataclass
class HourlyTotals:
    """The hourly totals under ``root``: written hours and late deltas by batch, open hours in the checkpoint."""

    spark: SparkSession
    root: str
    delay: str = "1 hour"

    def run(self, orders: DataFrame, ts_col: str = "createdAt"):
        return J.run_available_now(hours_with_late(orders, ts_col, self.delay),
                                   lambda df, bid: J.write_batch(df, f"{self.root}/hours", bid), self.checkpoint())

    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def written(self, kind: str) -> DataFrame:
        """``closed`` totals or ``late`` deltas, with the batch that wrote them."""
        return J.read_batches(self.spark, f"{self.root}/hours", T.StructType([*OUT.fields, T.StructField("batch_id", T.IntegerType())])).where(F.col("kind") == kind)

    def open_hours(self) -> DataFrame:
        """What the state holds: hours that the watermark has not passed."""
        state = self.spark.read.format("statestore").option("stateVarName", "total").load(self.checkpoint())
        return state.select("key.hourStart", "value.orders", "value.cents")

    def corrected(self) -> DataFrame:
        """(hour, count, revenue): closed totals, late deltas and open hours together, equal to D5 over all rows."""
        parts = self.written("closed").unionByName(self.written("late")).select("hourStart", "orders", "cents").unionByName(self.open_hours())
        hour = F.date_format(F.timestamp_millis(F.col("hourStart")), "yyyy-MM-dd'T'HH:00:00'Z'")
        return parts.groupBy("hourStart").agg(F.sum("orders").alias("count"), F.sum("cents").alias("cents")).select(
            hour.alias("hour"), "count", (F.col("cents") / 100).cast("decimal(38,2)").alias("revenue"))
