"""Deep pages by position (F1): a directory of row counts finds the rows of an offset.

The store is laid out by time, so the newest-first order of its hours is known without reading it.  The directory holds the
number of rows of each hour; running sums say which hours an offset falls in, and only these are read, by a folder and a
time range, with the offset left within them.  ``page_after`` needs no offset at all: it goes on behind the last row seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.operators import lookup as L

FOLDERS = ("event_date", "event_month")


def folder_col(store: DataFrame) -> str:
    return next(c for c in FOLDERS if c in store.columns)


def directory_of(store: DataFrame, ts_col: str = "eventTimestamp") -> DataFrame:
    """(folder, hour, rows): one row for each hour of a store; rows without a time have a null hour."""
    return store.groupBy(F.col(folder_col(store)).alias("folder"), F.date_trunc("hour", F.col(ts_col)).alias("hour")).agg(
        F.count(F.lit(1)).alias("rows"))


def write_directory(spark: SparkSession, store: DataFrame, path: str, ts_col: str = "eventTimestamp") -> None:
    """Writes the directory of a store that was written; later batches may append theirs (``mode`` append adds up)."""
    directory_of(store, ts_col).write.mode("append").parquet(path)


def _span(directory: DataFrame, offset: int, size: int):
    """First and last hour and folder of the rows [offset, offset + size), and how many rows of these come before."""
    hours = directory.groupBy("folder", "hour").agg(F.sum("rows").alias("rows")).where("rows <> 0")
    newest = Window.orderBy(F.col("hour").desc_nulls_last(), F.col("folder").desc_nulls_last())
    # a row an hour, however many orders: sorted in one task
    placed = hours.withColumn("before", F.sum("rows").over(newest.rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["before"])
    hit = placed.where((F.col("before") < offset + size) & (F.col("before") + F.col("rows") > offset))
    return hit.agg(F.min("before").alias("before"), F.min("hour").alias("first"), F.max("hour").alias("last"),
                   F.min("folder").alias("first_folder"), F.max("folder").alias("last_folder"),
                   F.max(F.col("hour").isNull()).alias("untimed"), F.count(F.lit(1)).alias("n")).first()


def page_by_position(store: DataFrame, directory: DataFrame, page: int = L.DEFAULT_PAGE, size: int = L.DEFAULT_SIZE,
                     ts_col: str = "eventTimestamp") -> DataFrame:
    """The page of ``lookup.page_orders``, read from the hours it falls in alone."""
    if page < 0 or size < 1:
        raise ValueError("page must be >= 0 and size >= 1")
    offset = page * size
    span = _span(directory, offset, size)
    if not span["n"]:
        return store.where("false")
    folder, ts = F.col(folder_col(store)), F.col(ts_col)
    timed = F.lit(False)
    if span["first"] is not None:
        low, high = F.lit(span["first"]), F.lit(span["last"]) + F.expr("INTERVAL 1 HOUR")
        timed = folder.between(F.lit(span["first_folder"]), F.lit(span["last_folder"])) & (ts >= low) & (ts < high)
    within = store.where(timed | (folder.isNull() & ts.isNull()) if span["untimed"] else timed)
    return within.orderBy(*L.newest_first(ts_col)).offset(offset - span["before"]).limit(size)


def page_after(store: DataFrame, last_time, last_id: str, size: int = L.DEFAULT_SIZE, ts_col: str = "eventTimestamp") -> DataFrame:
    """The ``size`` rows that follow a row (its time, or None, and id) in newest-first order."""
    ts, key = F.col(ts_col), F.col("orderId")
    if last_time is None:
        rest = ts.isNull() & (key > last_id)
    else:
        at = F.lit(last_time).cast("timestamp")
        rest = (ts < at) | ((ts == at) & (key > last_id)) | ts.isNull()
        if (name := next((c for c in FOLDERS if c in store.columns), None)) is not None:
            day = F.trunc(at, "month") if name == "event_month" else at.cast("date")
            rest = rest & (F.col(name).isNull() | (F.col(name) <= day))
    return store.where(rest).orderBy(*L.newest_first(ts_col)).limit(size)
