"""Filtered, sorted and paged lookups.

Each lookup is a ``filter`` that Catalyst pushes into the Parquet scan, followed
by a sort.  On the store (``store.write_store``) a time range also prunes the
date folders, and equality on an id meets the row groups' Bloom filters.
Pages are ``orderBy().offset().limit()``, which Spark plans as a single
TakeOrderedAndProject: a bounded top-(offset+size) heap per task and one small
merge, never a global sort.  Ties on the time column are broken by
``orderId`` so that pages are stable (nulls last on the descending sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import scalars as X

DEFAULT_PAGE = 0
DEFAULT_SIZE = 20


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("timestamp")


def newest_first(ts_col: str, key: str = "orderId") -> list[Column]:
    return [F.col(ts_col).desc_nulls_last(), F.col(key).asc()]


# ------------------------------------------------------------------------ F1
def page_orders(df: DataFrame, ts_col: str = "eventTimestamp", page: int = DEFAULT_PAGE,
                size: int = DEFAULT_SIZE) -> DataFrame:
    """One page, newest first.  Deep pages cost ``page*size`` rows per task."""
    if page < 0 or size < 1:
        raise ValueError("page must be >= 0 and size >= 1")
    out = df.orderBy(*newest_first(ts_col))
    if page:
        out = out.offset(page * size)
    return out.limit(size)


def page_info(df: DataFrame, size: int = DEFAULT_SIZE) -> DataFrame:
    """Total rows and pages of a result (one global count)."""
    return df.agg(F.count(F.lit(1)).alias("totalElements")).select(
        "totalElements", F.ceil(F.col("totalElements") / F.lit(size)).cast("bigint").alias("totalPages"),
        F.lit(size).alias("size"))


# --------------------------------------------------------------------- B11/B12
def get_order(df: DataFrame, order_id: str) -> DataFrame:
    return df.filter(F.col("orderId") == order_id)


def require_order(df: DataFrame, order_id: str):
    """Driver helper: the one row of ``order_id`` or ``LookupError``."""
    rows = get_order(df, order_id).take(1)
    if not rows:
        raise LookupError(S.NOT_FOUND_MESSAGE + order_id)
    return rows[0]


def orders_exist(ids: DataFrame, df: DataFrame, id_col: str = "orderId") -> DataFrame:
    """Existence of many ids at once: ids + ``exists``.

    The stored ids are first reduced to the asked ones (a semi-join, with the
    ids broadcast when Spark's size check allows it), so only hits are
    de-duplicated and joined back."""
    asked = ids.select(F.col(id_col).alias("_aid"))
    stored = (df.select(F.col(id_col).alias("_sid")).join(asked, F.col("_sid") == F.col("_aid"), "left_semi")
              .distinct().withColumn("_hit", F.lit(True)))
    return (ids.join(stored, ids[id_col] == stored["_sid"], "left")
            .select(*[ids[c] for c in ids.columns], F.coalesce(F.col("_hit"), F.lit(False)).alias("exists")))


def orders_exist_bucketed(ids: DataFrame, stored: DataFrame, id_col: str = "orderId") -> DataFrame:
    """``orders_exist`` against an id table (``store.write_id_table``): the stored ids are distinct and stay where they are,
    only the asked ids are shuffled to their buckets."""
    held = stored.select(F.col(id_col).alias("_sid"), F.lit(True).alias("_hit"))
    # both sides may be large; a broadcast of the stored ids would grow with the store
    return ids.join(held.hint("merge"), ids[id_col] == held["_sid"], "left").select(
        *[ids[c] for c in ids.columns], F.coalesce("_hit", F.lit(False)).alias("exists"))


def existing_ids(ids: DataFrame, df: DataFrame, id_col: str = "orderId") -> DataFrame:
    return ids.join(df.select(id_col), id_col, "left_semi")


def missing_ids(ids: DataFrame, df: DataFrame, id_col: str = "orderId") -> DataFrame:
    return ids.join(df.select(id_col), id_col, "left_anti")


# --------------------------------------------------------------- B13-B17
def orders_by_status(df, status, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    return page_orders(df.filter(F.col("status") == status), ts_col, page, size)


def orders_by_customer(df, customer_id, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    return page_orders(df.filter(F.col("customerId") == customer_id), ts_col, page, size)


def orders_by_region(df, region, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    return page_orders(df.filter(F.col("region") == region), ts_col, page, size)


def orders_by_tier(df, tier, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    return page_orders(df.filter(F.col("customerTier") == tier), ts_col, page, size)


def lifecycle_by_status(df, status, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="createdAt"):
    """P2 form: the status parameter is upper-cased and must be a known one."""
    st = X.check_enum(status, S.LIFECYCLE_STATUSES, "status")
    return page_orders(df.filter(F.col("status") == st), ts_col, page, size)


def status_history(df: DataFrame, status: str, ts_col: str = "createdAt") -> DataFrame:
    """Every row of a status, newest first, unpaged."""
    return df.filter(F.col("status") == status).orderBy(*newest_first(ts_col))


# -------------------------------------------------------------- B18-B20 ranges
def _dated(df: DataFrame, from_, to) -> DataFrame:
    """The date folders of a store that a time range touches; any other table as it is."""
    for col, unit in (("event_date", "day"), ("event_month", "month")):
        if col in df.columns:
            first, last = (F.trunc(_ts(x).cast("date"), unit) if unit == "month" else _ts(x).cast("date") for x in (from_, to))
            df = df.filter(F.col(col).between(first, last))
    return df


def orders_between(df, from_, to, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    """P1 range: **both bounds exclusive**."""
    ts = F.col(ts_col)
    return page_orders(_dated(df, from_, to).filter((ts > _ts(from_)) & (ts < _ts(to))), ts_col, page, size)


def orders_in_range(df, from_, to, page=None, size=None, ts_col="createdAt"):
    """P2 range: both bounds inclusive; unpaged when ``page`` is None."""
    out = _dated(df, from_, to).filter(F.col(ts_col).between(_ts(from_), _ts(to)))
    if page is None:
        return out
    return page_orders(out, ts_col, page, size or DEFAULT_SIZE)


def status_in_range(df, status, from_, to, ts_col="createdAt"):
    return _dated(df, from_, to).filter((F.col("status") == status) & F.col(ts_col).between(_ts(from_), _ts(to)))


# ------------------------------------------------------------------- B21-B23
def region_priority(df, region, priority, page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="createdAt"):
    pr = X.check_enum(priority, S.PRIORITIES, "priority")
    return page_orders(df.filter((F.col("region") == region.upper()) & (F.col("priority") == pr)),
                       ts_col, page, size)


def by_processing_status(df: DataFrame, processing_status: str = "DLQ") -> DataFrame:
    return df.filter(F.col("processingStatus") == processing_status)


def failed_orders(df: DataFrame, min_retry: int = 0) -> DataFrame:
    """Status FAILED with more than ``min_retry`` retries (null excluded)."""
    return df.filter((F.col("status") == "FAILED") & (F.col("retryCount") > min_retry))


# ------------------------------------------------------------------------ B24
def search_orders(df, status=None, customer_id=None, region=None, tier=None, from_=None, to=None,
                  page=DEFAULT_PAGE, size=DEFAULT_SIZE, ts_col="eventTimestamp"):
    """Optional filters with first-match precedence (not AND-ed): status, else
    customer, else region, else tier, else a range when both ends are given,
    else everything."""
    if status is not None:
        return orders_by_status(df, status, page, size, ts_col)
    if customer_id is not None:
        return orders_by_customer(df, customer_id, page, size, ts_col)
    if region is not None:
        return orders_by_region(df, region, page, size, ts_col)
    if tier is not None:
        return orders_by_tier(df, tier, page, size, ts_col)
    if from_ is not None and to is not None:
        return orders_between(df, from_, to, page, size, ts_col)
    return page_orders(df, ts_col, page, size)


# ------------------------------------------------------------------- F2 / E1
def customer_top(df: DataFrame, customer_id: str, n: int = 10, ts_col: str = "createdAt") -> DataFrame:
    return df.filter(F.col("customerId") == customer_id).orderBy(*newest_first(ts_col)).limit(n)


def recent_per_customer(df: DataFrame, n: int = 10, ts_col: str = "createdAt") -> DataFrame:
    """Newest ``n`` orders of every customer in one pass.

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so a customer with a huge share of the rows sends at
    most ``n`` rows per map task."""
    w = Window.partitionBy("customerId").orderBy(*newest_first(ts_col))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
