"""Rolling windows from hourly partial aggregates.

Each batch that changes the store leaves its partial sums by hour and status; they are additive, so a change of rows is the
sums of the rows after it less those before.  A report over a time range adds the whole hours in it and reads from the store
only the rows of the hours that the range cuts; counts over all time read no row of the store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import lookup as L
from orderflow.operators import metrics as M

SUMS = ["orders", "revenue", "keptOrders", "keptRevenue"]


def _sums(rows: DataFrame, *by) -> DataFrame:
    kept = F.col("totalAmount").isNotNull() & ~F.coalesce(F.col("status"), F.lit("")).isin(*S.REVENUE_EXCLUDED_STATUSES)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("totalAmount"), F.lit(0)).cast("decimal(38,2)").alias("revenue"),
        F.count_if(kept).alias("keptOrders"),
        F.coalesce(F.sum(F.when(kept, F.col("totalAmount"))), F.lit(0)).cast("decimal(38,2)").alias("keptRevenue"))


def hourly_partials(rows: DataFrame, ts_col: str = "createdAt") -> DataFrame:
    """(hour, status, sums) of some rows; a null time or status is a group like any other."""
    return _sums(rows, F.date_trunc("hour", F.col(ts_col)).alias("hour"), "status")


def change(before: DataFrame | None, after: DataFrame, ts_col: str = "createdAt") -> DataFrame:
    """Partials of a change: what ``after`` adds to the sums of ``before``, groups without a change left out."""
    new = hourly_partials(after, ts_col)
    if before is None:
        return new
    old = hourly_partials(before, ts_col).withColumns({c: (-F.col(c)).cast(new.schema[c].dataType) for c in SUMS})
    return folded(new.unionByName(old))


def folded(partials: DataFrame) -> DataFrame:
    """One row a group; what cancels out is gone."""
    total = partials.groupBy("hour", "status").agg(*(F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in SUMS))
    return total.where(" or ".join(f"{c} <> 0" for c in SUMS))


def write_partials(partials: DataFrame, root: str, batch_id: int) -> None:
    """A batch that runs again replaces its own partials."""
    partials.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(root).drop("batch_id")


def _cut(partials: DataFrame, store: DataFrame, since: Column, until: Column | None, ts_col: str) -> tuple[DataFrame, DataFrame]:
    """Partials of the whole hours of [since, until], and the store's rows of the hours that its ends cut."""
    first = F.date_trunc("hour", since)
    first = F.when(first == since, first).otherwise(first + F.expr("INTERVAL 1 HOUR"))  # the first whole hour
    ts = F.col(ts_col)
    if until is None:
        return partials.where(F.col("hour") >= first), L._dated(store, since, first).where((ts >= since) & (ts < first))
    last = F.greatest(F.date_trunc("hour", until), first)  # the hour that holds the end, which belongs to the range
    whole = partials.where((F.col("hour") >= first) & (F.col("hour") < last))
    head = L._dated(store, since, first).where((ts >= since) & (ts < first) & (ts <= until))
    tail = L._dated(store, last, until).where((ts >= last) & (ts <= until))
    return whole, head.unionByName(tail)


def hourly_stats(partials: DataFrame, store: DataFrame, since: Column, ts_col: str = "createdAt") -> DataFrame:
    """D5 from partials; the store is read for the hour that ``since`` cuts alone."""
    whole, edge = _cut(partials, store, since, None, ts_col)
    rows = whole.select("hour", *SUMS).unionByName(hourly_partials(edge, ts_col).select("hour", *SUMS))
    label = F.date_format("hour", "yyyy-MM-dd'T'HH:00:00'Z'")
    return rows.groupBy(label.alias("hour")).agg(F.sum("orders").alias("count"), F.sum("revenue").cast("decimal(38,2)").alias("revenue")).where(
        "count <> 0").orderBy("hour")


def resync(partials: DataFrame, store: DataFrame, as_of: Column, hours: int = 24, ts_col: str = "createdAt") -> DataFrame:
    """D12 from partials: ``metrics.resync`` with the store read for the hours at both ends of the range alone."""
    whole, edge = _cut(partials, store, as_of - F.expr(f"INTERVAL {int(hours)} HOURS"), as_of, ts_col)
    zero = F.lit(0).cast("long")
    everything = partials.select("status", "orders", zero.alias("inRange"), F.lit(0).cast("decimal(38,2)").alias("revenue"))
    ranged = whole.select(*SUMS).unionByName(hourly_partials(edge, ts_col).select(*SUMS)).select(
        F.lit(None).cast("string").alias("status"), zero.alias("orders"), F.col("orders").alias("inRange"), F.col("keptRevenue").alias("revenue"))
    rows = everything.unionByName(ranged)

    def of(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("orders"))), F.lit(0))

    wide = rows.agg(*(of(s).alias(s) for s in S.LIFECYCLE_STATUSES), of("FAILED").alias("failedOrders"),
                    F.coalesce(F.sum("inRange"), F.lit(0)).alias("totalOrders24h"),
                    F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(38,2)").alias("totalRevenue24h"))
    counts = F.map_from_arrays(F.array(*[F.lit(s) for s in S.LIFECYCLE_STATUSES]), F.array(*[F.col(s) for s in S.LIFECYCLE_STATUSES]))
    return wide.select(counts.alias("statusCounts"), "totalRevenue24h", "totalOrders24h", "failedOrders",
                       M.money_avg("totalRevenue24h", "totalOrders24h").alias("avgOrderValue"), as_of.alias("snapshotAt"))
