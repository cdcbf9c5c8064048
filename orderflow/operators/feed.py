"""Live feed payloads (A8-A10, B7, B8, F4): lean projections of stored
orders.  Pure column pruning + per-row expressions, so the same functions run
on a batch DataFrame or inside a streaming query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions import scalars as X

LEAN_REQUIRED = ["orderId", "customerId", "customerTier", "status", "totalAmount", "currency", "region"]
LIFECYCLE_REQUIRED = ["orderId", "customerId", "status", "priority", "region", "category", "totalAmount",
                      "currency", "partition"]


def lean_columns(get, ts_col: str = "eventTimestamp") -> list[Column]:
    """The 10 feed fields from event fields (``get(name) -> Column``)."""
    return [
        *[get(c).alias(c) for c in LEAN_REQUIRED],
        F.coalesce(get("paymentMethod"), F.lit("")).alias("paymentMethod"),
        F.coalesce(X.iso_text(get(ts_col)), F.lit("")).alias("timestamp"),
        X.item_count(get("items")).alias("itemCount"),
    ]


def lean_ok(get) -> Column:
    """A null in any undefaulted field drops the row from the feed."""
    ok = None
    for c in LEAN_REQUIRED:
        ok = get(c).isNotNull() if ok is None else ok & get(c).isNotNull()
    return ok


def lean_order(df: DataFrame, ts_col: str = "eventTimestamp", keep: list[str] | None = None) -> DataFrame:
    """The 10-field feed row (plus ``keep`` columns, e.g. an arrival
    sequence).  A null in any undefaulted field drops the row from the feed
    only (the stored order is unaffected)."""
    return df.na.drop(subset=LEAN_REQUIRED).select(*lean_columns(F.col, ts_col), *(keep or []))


def lean_lifecycle(df: DataFrame, partition: Column | None = None) -> DataFrame:
    """The 11-field lifecycle feed row.  ``partition`` defaults to the
    order's priority lane (its P2 routing)."""
    part = partition if partition is not None else X.priority_lane(
        X.partition_key(F.col("priority"), F.col("customerId")))
    with_part = df.withColumn("partition", part)
    return with_part.na.drop(subset=LIFECYCLE_REQUIRED).select(
        "orderId", "customerId",
        F.coalesce(F.col("customerName"), F.lit("")).alias("customerName"),
        "status", "priority", "region", "category", "totalAmount", "currency", "partition",
        F.coalesce(X.iso_text(F.col("createdAt")), F.lit("")).alias("timestamp"),
    )


def feed_json(lean: DataFrame) -> DataFrame:
    """One JSON payload per feed row (the socket itself is not built)."""
    return lean.select(F.to_json(F.struct(*lean.columns)).alias("payload"))


def stats_json(snapshot: DataFrame) -> DataFrame:
    """A10: the dashboard snapshot as one JSON payload."""
    return snapshot.select(F.to_json(F.struct(*snapshot.columns)).alias("payload"))


def recent_feed(feed: DataFrame, seq_col: str, n: int = 50) -> DataFrame:
    """the newest ``n`` feed rows in arrival order (top-k, not a sort)."""
    return feed.orderBy(F.col(seq_col).desc()).limit(n)
