"""Aggregations.

Every metric is a ``groupBy``/``agg`` (partial + final HashAggregate, so a
hot group is reduced map-side before the shuffle) or a global ``agg``
with conditional aggregates that reads the data once.  Counter maps are
built from grouping sets in the same pass, then folded over the handful of
(dimension, value) rows.  No joins, no driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import scalars as X

REVENUE = "decimal(38,2)"


def _rev(c) -> Column:
    """Sum of amounts; ``$sum`` over nothing is 0, Spark's is null."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(REVENUE)


def money_avg(total, n, scale: int = 2, type_=S.AMOUNT) -> Column:
    """``total / n`` rounded HALF_UP to ``scale`` places, exactly (integer units
    with an exact remainder), and 0 when ``n`` is 0 -- ``BigDecimal.divide(n, 2,
    HALF_UP)``."""
    t = total if isinstance(total, Column) else F.col(total)
    cnt = (n if isinstance(n, Column) else F.col(n)).cast("decimal(20,0)")
    cents = (t.cast("decimal(38,2)") * 100).cast("decimal(38,0)")
    units = (cents.cast(f"decimal({38 - scale + 2},0)") * F.lit(10 ** (scale - 2)).cast(f"decimal({scale - 1},0)")).cast("decimal(38,0)")
    a = F.abs(units)
    r = a % cnt
    q = ((a - r) / cnt).cast("decimal(38,0)") + F.when(r * 2 >= cnt, 1).otherwise(0)
    signed = F.when(units < 0, -q).otherwise(q)
    return F.when(cnt > 0, (signed / 10**scale).cast(type_)).otherwise(F.lit(0).cast(type_))


def exact_avg(total, n) -> Column:
    """The store's own average (D1, D14), which isn't rounded to cents: 6 places."""
    return money_avg(total, n, 6, "decimal(38,6)")


# --------------------------------------------------------------------- P1
def sales_summary(docs: DataFrame) -> DataFrame:
    """Count / revenue / average of SUCCESS rows; no rows -> no row."""
    ok = docs.filter(F.col("processingStatus") == "SUCCESS")
    return (
        ok.agg(F.count(F.lit(1)).alias("totalOrders"), _rev("totalAmount").alias("totalRevenue"))
        .filter(F.col("totalOrders") > 0)
        .withColumn("avgOrderValue", exact_avg("totalRevenue", "totalOrders"))
    )


def regional_sales(docs: DataFrame) -> DataFrame:
    """SUCCESS rows by region, revenue descending."""
    return (
        docs.filter(F.col("processingStatus") == "SUCCESS")
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("totalOrders"), _rev("totalAmount").alias("totalRevenue"))
        .orderBy(F.col("totalRevenue").desc(), F.col("region").asc_nulls_first())
    )


def tier_distribution(docs: DataFrame) -> DataFrame:
    """D3: **all** rows by tier (no SUCCESS filter), revenue descending."""
    return (
        docs.groupBy("customerTier")
        .agg(F.count(F.lit(1)).alias("count"), _rev("totalAmount").alias("revenue"))
        .orderBy(F.col("revenue").desc(), F.col("customerTier").asc_nulls_first())
    )


def status_success_count(docs: DataFrame, status: str) -> DataFrame:
    """Rows with ``status`` that were stored successfully."""
    return docs.agg(
        F.count_if((F.col("status") == status) & (F.col("processingStatus") == "SUCCESS")).alias("orders"))


def store_report(docs: DataFrame) -> DataFrame:
    """Total rows, DLQ rows, the sales summary and the tier distribution
    in one row, from one scan (grouping sets: per tier + grand total)."""
    g = docs.groupingSets(
        [["customerTier"], []], "customerTier",
    ).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("n"),
        _rev("totalAmount").alias("rev"),
        F.count_if(F.col("processingStatus") == "DLQ").alias("dlq"),
        F.count_if(F.col("processingStatus") == "SUCCESS").alias("okN"),
        _rev(F.when(F.col("processingStatus") == "SUCCESS", F.col("totalAmount"))).alias("okRev"),
    )
    tier = F.struct(F.col("customerTier").alias("id"), F.col("n").alias("count"), F.col("rev").alias("revenue"))
    total = F.col("gid") == 1
    out = g.agg(
        F.max(F.when(total, F.col("n"))).alias("totalOrdersInDb"),
        F.max(F.when(total, F.col("dlq"))).alias("dlqOrders"),
        F.max(F.when(total, F.col("okN"))).alias("totalOrders"),
        F.max(F.when(total, F.col("okRev"))).alias("totalRevenue"),
        F.collect_list(F.when(~total, tier)).alias("_tiers"),
    )
    return out.select(
        F.coalesce("totalOrdersInDb", F.lit(0)).alias("totalOrdersInDb"),
        F.coalesce("dlqOrders", F.lit(0)).alias("dlqOrders"),
        F.coalesce("totalOrders", F.lit(0)).alias("totalOrders"),
        F.coalesce("totalRevenue", F.lit(0)).cast(REVENUE).alias("totalRevenue"),
        exact_avg(F.coalesce("totalRevenue", F.lit(0)), F.coalesce("totalOrders", F.lit(0))).alias("avgOrderValue"),
        F.array_sort("_tiers", lambda a, b: F.when(a["revenue"] > b["revenue"], -1)
                     .when(a["revenue"] < b["revenue"], 1).otherwise(0)).alias("tierDistribution"),
    )


# --------------------------------------------------------------------- P2
def top_categories(orders: DataFrame, since, n: int = 5) -> DataFrame:
    """Revenue by category since ``since``; the top ``n`` (sort + limit is
    planned as TakeOrderedAndProject over the grouped rows)."""
    return (
        orders.filter(F.col("createdAt") >= since)
        .groupBy("category")
        .agg(_rev("totalAmount").alias("totalRevenue"), F.count(F.lit(1)).alias("orderCount"))
        .orderBy(F.col("totalRevenue").desc(), F.col("category").asc_nulls_first())
        .limit(n)
    )


def hourly_stats(orders: DataFrame, since) -> DataFrame:
    """Count and revenue per UTC hour label since ``since``, ascending;
    empty hours are absent."""
    return (
        orders.filter(F.col("createdAt") >= since)
        .groupBy(X.hour_label("createdAt").alias("hour"))
        .agg(F.count(F.lit(1)).alias("count"), _rev("totalAmount").alias("revenue"))
        .orderBy("hour")
    )


def hourly_chart(orders: DataFrame, hours: int, as_of: Column) -> DataFrame:
    """D5 over the last ``hours`` hours, as hour / orders / revenue."""
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return hourly_stats(orders, since).select(
        "hour", F.col("count").alias("orders"), F.coalesce("revenue", F.lit(0)).cast(REVENUE).alias("revenue"))


def _status_count_cols(statuses=S.LIFECYCLE_STATUSES) -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in statuses]


def status_counts(orders: DataFrame) -> DataFrame:
    """One count per known status, zeros included (one pass: conditional
    counts, then unpivoted into rows)."""
    wide = orders.agg(*_status_count_cols())
    return wide.unpivot([], S.LIFECYCLE_STATUSES, "status", "orders")


DIMENSIONS = ["status", "region", "priority", "category"]


def with_default_dimensions(orders: DataFrame) -> DataFrame:
    """The counters' dimensions, null values under their defaults."""
    defaults = {"status": S.UNKNOWN, "region": S.UNKNOWN, "priority": S.DEFAULT_PRIORITY, "category": S.DEFAULT_CATEGORY}
    return orders.withColumns({d: F.coalesce(d, F.lit(defaults[d])) for d in DIMENSIONS})


def _dims(orders: DataFrame) -> DataFrame:
    return with_default_dimensions(orders.withColumn("rawStatus", F.col("status"))).select(*DIMENSIONS, "totalAmount", "rawStatus")


# grouping_id() of each single-column grouping set over DIMENSIONS
_GID = {d: (1 << len(DIMENSIONS)) - 1 - (1 << (len(DIMENSIONS) - 1 - i)) for i, d in enumerate(DIMENSIONS)}
_GID_TOTAL = (1 << len(DIMENSIONS)) - 1


def _revenue_eligible() -> Column:
    # a null status is kept; only CANCELLED and FAILED are excluded
    return F.col("totalAmount").isNotNull() & ~F.coalesce(F.col("rawStatus"), F.lit(S.UNKNOWN)).isin(
        *S.REVENUE_EXCLUDED_STATUSES)


def _counter_sets(orders: DataFrame) -> DataFrame:
    """One scan: a count per (dimension, value) plus the grand-total row with
    the revenue counters (grouping sets = one Expand + one HashAggregate)."""
    d = _dims(orders)
    elig = _revenue_eligible()
    return d.groupingSets([[c] for c in DIMENSIONS] + [[]], *DIMENSIONS).agg(
        F.grouping_id().alias("gid"),
        F.count(F.lit(1)).alias("orders"),
        _rev(F.when(elig, F.col("totalAmount"))).alias("revenue"),
        F.count_if(elig).alias("revenueOrders"),
        F.count_if(F.col("rawStatus") == "FAILED").alias("failed"),
    )


def dimension_counts(orders: DataFrame) -> DataFrame:
    """Running counts by status, region, priority and category (null keys
    defaulted) in long form: dimension, value, orders."""
    g = _counter_sets(orders).filter(F.col("gid") != _GID_TOTAL)
    dim = None
    for name, gid in _GID.items():
        dim = F.when(F.col("gid") == gid, F.lit(name)) if dim is None else dim.when(F.col("gid") == gid, name)
    return g.select(dim.alias("dimension"), F.coalesce(*DIMENSIONS).alias("value"), "orders")


def live_revenue(orders: DataFrame) -> DataFrame:
    """Revenue and count of orders with an amount whose status is not
    CANCELLED/FAILED (null status kept), and the average."""
    d = _dims(orders)
    elig = _revenue_eligible()
    return d.agg(
        _rev(F.when(elig, F.col("totalAmount"))).alias("totalRevenue"),
        F.count_if(elig).alias("totalOrders"),
    ).withColumn("avgOrderValue", money_avg("totalRevenue", "totalOrders"))


def failed_count(orders: DataFrame) -> DataFrame:
    """D10."""
    return orders.agg(F.count_if(F.col("status") == "FAILED").alias("failedOrders"))


def _sorted_map(entries: Column) -> Column:
    return F.map_from_entries(F.array_sort(entries))


def counter_sets(orders: DataFrame) -> DataFrame:
    """The running counters as rows (gid, dimension values, orders, revenue,
    revenueOrders, failed): what a stream keeps in its state store."""
    return _counter_sets(orders)


def dashboard_snapshot(orders: DataFrame, as_of: Column) -> DataFrame:
    """The dashboard row -- four count maps, revenue, orders, failed and
    average, from one scan plus a fold over the (dimension, value) rows."""
    return snapshot_from_counters(_counter_sets(orders), as_of)


def snapshot_from_counters(g: DataFrame, as_of: Column) -> DataFrame:
    """Fold counter rows (``counter_sets``) into the one snapshot row."""
    entry = F.struct(F.coalesce(*DIMENSIONS).alias("key"), F.col("orders").alias("value"))
    total = F.col("gid") == _GID_TOTAL
    folded = g.agg(
        *[_sorted_map(F.collect_list(F.when(F.col("gid") == gid, entry))).alias(f"{d}Counts")
          for d, gid in _GID.items()],
        F.max(F.when(total, F.col("revenue"))).alias("rev"),
        F.max(F.when(total, F.col("revenueOrders"))).alias("n"),
        F.max(F.when(total, F.col("failed"))).alias("failed"),
    )
    return folded.select(
        *[f"{d}Counts" for d in DIMENSIONS],
        F.round(F.coalesce("rev", F.lit(0)), 2).cast(REVENUE).alias("totalRevenue24h"),
        F.coalesce("n", F.lit(0)).alias("totalOrders24h"),
        F.coalesce("failed", F.lit(0)).alias("failedOrders"),
        money_avg(F.coalesce("rev", F.lit(0)), F.coalesce("n", F.lit(0))).alias("avgOrderValue"),
        as_of.alias("snapshotAt"),
    )


def resync(orders: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Recompute from the store -- all-time status counts (zeros
    included); revenue of the last ``hours`` (inclusive range) without
    CANCELLED/FAILED/null amounts; ``totalOrders24h`` counts **every** row in
    the range.  One scan, conditional aggregates."""
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    in_range = F.col("createdAt").between(since, as_of)
    elig = in_range & F.col("totalAmount").isNotNull() & ~F.coalesce(F.col("status"), F.lit("")).isin(
        *S.REVENUE_EXCLUDED_STATUSES)
    wide = orders.agg(
        *_status_count_cols(),
        _rev(F.when(elig, F.col("totalAmount"))).alias("totalRevenue24h"),
        F.count_if(in_range).alias("totalOrders24h"),
        F.count_if(F.col("status") == "FAILED").alias("failedOrders"),
    )
    counts = F.map_from_arrays(F.array(*[F.lit(s) for s in S.LIFECYCLE_STATUSES]),
                               F.array(*[F.col(s) for s in S.LIFECYCLE_STATUSES]))
    return wide.select(
        counts.alias("statusCounts"), "totalRevenue24h", "totalOrders24h", "failedOrders",
        money_avg("totalRevenue24h", "totalOrders24h").alias("avgOrderValue"),
        as_of.alias("snapshotAt"),
    )


# ------------------------------------------------------------ dashboard maths
def session_totals(feed: DataFrame) -> DataFrame:
    """Orders, premium, standard (every other tier), revenue (amounts
    that do not parse count 0) rounded, and the rounded average (0 if none)."""
    amount = F.coalesce(F.col("totalAmount").cast("string").try_cast("decimal(38,2)"), F.lit(0))
    t = feed.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("customerTier") == S.PREMIUM).alias("premium"),
        F.count_if(F.coalesce(F.col("customerTier"), F.lit("")) != S.PREMIUM).alias("standard"),
        F.coalesce(F.sum(amount), F.lit(0)).cast(REVENUE).alias("_rev"),
    )
    half_up = lambda x: F.floor(x + F.lit(0.5).cast("decimal(2,1)")).cast("bigint")
    return t.select(
        "orders", "premium", "standard",
        half_up(F.col("_rev")).alias("revenue"),
        F.when(F.col("orders") > 0, half_up(F.col("_rev") / F.col("orders").cast("decimal(20,0)")))
        .otherwise(0).cast("bigint").alias("avgOrder"),
    )


def premium_counts(feed: DataFrame) -> DataFrame:
    """Running counts behind D16: total, premium, every other tier."""
    return feed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("customerTier") == S.PREMIUM).alias("premium"),
        F.count_if(F.coalesce(F.col("customerTier"), F.lit("")) != S.PREMIUM).alias("standard"),
    )


def premium_split_from_counts(t: DataFrame) -> DataFrame:
    return t.select(
        "premium", "standard",
        F.when(F.col("total") > 0, X.pct("premium", "total")).otherwise(0).alias("premiumPct"),
        F.when(F.col("total") > 0, X.pct("standard", "total")).otherwise(0).alias("standardPct"),
    )


def premium_split(feed: DataFrame) -> DataFrame:
    """Premium vs the rest, counts and rounded percents of the total."""
    return premium_split_from_counts(premium_counts(feed))


def share_counts(feed: DataFrame, col: str) -> DataFrame:
    """Running counts behind D17/D18: orders per value of ``col``."""
    return feed.groupBy(col).agg(F.count(F.lit(1)).alias("orders"))


def share_from_counts(counts: DataFrame, col: str) -> DataFrame:
    """Rounded percent of each value's count; the total is a scalar subquery
    over the (small) count table, not a join."""
    total = counts.agg(F.sum("orders")).scalar()
    return (counts.select(col, "orders", X.pct(F.col("orders"), total).alias("pct"))
            .orderBy(F.col("orders").desc(), F.col(col).asc_nulls_first()))


def share_by(feed: DataFrame, col: str) -> DataFrame:
    """Count and rounded percent per value of ``col``, count descending."""
    return share_from_counts(share_counts(feed, col), col)


def region_share(feed: DataFrame) -> DataFrame:
    """D17."""
    return share_by(feed, "region")


def payment_share(feed: DataFrame) -> DataFrame:
    """D18 (a null payment arrives as "" from the feed)."""
    return share_by(feed, "paymentMethod")


def flow_counters(outcomes: DataFrame) -> DataFrame:
    """Published / publish-failed / processed / dead-lettered totals over
    an outcome log (``stage`` in publish|consume|dead_letter, ``ok``)."""
    st, ok = F.col("stage"), F.col("ok")
    return outcomes.agg(
        F.count_if((st == "publish") & ok).alias("published"),
        F.count_if((st == "publish") & ~ok).alias("publishFailed"),
        F.count_if((st == "consume") & ok).alias("processed"),
        F.count_if(st == "dead_letter").alias("deadLettered"),
    )


def item_totals(df: DataFrame, items_col: str = "items") -> DataFrame:
    """D20 + H11: item count and the total recomputed from the items."""
    return df.select(
        "orderId",
        X.item_count(F.col(items_col)).alias("itemCount"),
        X.items_total(F.col(items_col)).alias("itemsTotal"),
    )
