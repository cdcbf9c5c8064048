"""Order history as validity intervals (A4): any past state of the store from the log of arrivals.

An interval [validFrom, validTo) holds what the store says of an order from one arrival to the next that changes it: the
version that is last in the order of arrivals, and the sequence and time of the first one.  A version that comes in after a
later one was never current and makes no interval, unless it is the new first arrival.  The last interval has no end.  The
state as of a time is a filter; of many times, an equi-join on the order with a range condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.operators import store as ST


def validity(log: DataFrame, seq_cols: list[str], key: str = "orderId", ingested_col: str = "ingestedAt") -> DataFrame:
    """The rows of ``store.upsert_orders`` over time, with ``validFrom`` and ``validTo``.

    Rows without an arrival time are in no state.  Rows of one order that arrive at one time are combined before the
    shuffle; the rest of an order's history is sorted in one task."""
    data = [c for c in log.columns if c not in (key, ingested_col, "id", "createdAt", "updatedAt", *ST.STATE_COLS)]
    seq = ST.sequence(seq_cols)
    at = F.col(ingested_col)
    arrivals = log.where(at.isNotNull()).groupBy(key, at.alias("validFrom")).agg(
        F.max_by(F.struct(*[F.col(c) for c in data]), seq).alias("_row"), F.max(seq).alias("_last"), F.min(seq).alias("_first"))
    order = Window.partitionBy(key).orderBy("validFrom")
    known = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    states = arrivals.withColumns({
        "_now": F.max_by(F.struct("_row", F.col("validFrom").alias("updatedAt")), F.col("_last")).over(known),
        "_top": F.max("_last").over(known), "firstSeq": F.min("_first").over(known), "createdAt": F.min("validFrom").over(known)})
    before = {c: F.lag(c).over(order) for c in ("_top", "firstSeq")}
    changed = before["_top"].isNull() | (F.col("_top") != before["_top"]) | (F.col("firstSeq") != before["firstSeq"])
    kept = states.withColumn("_changed", changed).where("_changed").withColumn("validTo", F.lead("validFrom").over(order))
    return kept.select(ST.document_id(key, F.col("firstSeq"), seq_cols).alias("id"), key, "_now._row.*", "createdAt",
                       F.col("_now.updatedAt").alias("updatedAt"), "validFrom", "validTo")


def _holds(at: Column) -> Column:
    return (F.col("validFrom") <= at) & (F.col("validTo").isNull() | (F.col("validTo") > at))


def orders_as_of(intervals: DataFrame, at: Column) -> DataFrame:
    """The store as it was at ``at``: equal to ``store.upsert_orders`` of the log's arrivals up to it."""
    return intervals.where(_holds(at)).drop("validFrom", "validTo")


def versions_at(moments: DataFrame, intervals: DataFrame, key: str = "orderId", at_col: str = "at") -> DataFrame:
    """Each row of ``moments`` (an order and a time) with the version current then; nulls before the first arrival."""
    versions = intervals.withColumnRenamed(key, "_key")
    return moments.join(versions, (moments[key] == versions["_key"]) & _holds(moments[at_col]), "left").drop("_key", "validFrom", "validTo")
