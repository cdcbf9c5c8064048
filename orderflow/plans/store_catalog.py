"""Registered queries on the store's own structures: buckets, intervals, page directory, rollups, bucketed ids.

They extend ``catalog.QUERIES``; each has the SQL of what it must equal over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions import scalars as X
from orderflow.operators import history as HI
from orderflow.operators import lookup as L
from orderflow.operators import pages as PG
from orderflow.operators import rollups as RU
from orderflow.operators import store as ST
from orderflow.operators.buckets import BucketedStore
from orderflow.plans import catalog as C
from orderflow.plans import oracle as O
from orderflow.plans.catalog import DELIVERIES, DOC_COLS, DOCS, ORDER_P1, register
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX

SEQ = ["delivery", "seq"]


# --------------------------------------------------------------------- A4 / C2
@register("merge_buckets", C.UPSERT_SQL)
def q_merge_buckets(spark, sf):
    """A4 by buckets: all first deliveries, a hundredth of the second ones, that batch again, and the rest."""
    log = C._deliveries(spark, sf)
    store = BucketedStore(spark, scratch_path(spark, "merge_buckets"), SEQ, buckets=16)
    again = log.filter("delivery = 2")
    for batch in (log.filter("delivery = 1"), again.filter("seq % 100 = 0"), again.filter("seq % 100 = 0"), again.filter("seq % 100 <> 0")):
        store.merge(batch)
    return store.read().select(C._UPSERT_COLS)


# ------------------------------------------------------------------ A4, history
HISTORY_AT = "1997-05-06 07:00:00"
VALIDITY_SQL = """validity AS (
SELECT orderId, status, totalAmount, delivery, ingestedAt AS validFrom, lead(ingestedAt) OVER (PARTITION BY orderId ORDER BY ingestedAt) AS validTo,
 min(ingestedAt) OVER (PARTITION BY orderId) AS createdAt FROM deliveries)"""


@register("order_versions", O.with_("SELECT * FROM validity", DOCS, DELIVERIES, VALIDITY_SQL))
def q_order_versions(spark, sf):
    """The log as validity intervals."""
    return HI.validity(C._deliveries(spark, sf), SEQ).select(
        "orderId", "status", "totalAmount", "delivery", "validFrom", "validTo", "createdAt")


@register("orders_as_of", O.with_(
    "SELECT substr(sha256(orderId || ':' || CAST(firstDelivery AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 1, 24) AS id, orderId, "
    "customerId, status, totalAmount, delivery, seq, createdAt, updatedAt FROM (SELECT *, row_number() OVER (PARTITION BY orderId "
    "ORDER BY delivery DESC) AS rn, min(ingestedAt) OVER (PARTITION BY orderId) AS createdAt, ingestedAt AS updatedAt, "
    f"min(delivery) OVER (PARTITION BY orderId) AS firstDelivery FROM deliveries WHERE ingestedAt <= TIMESTAMP '{HISTORY_AT}') WHERE rn = 1",
    DOCS, DELIVERIES))
def q_orders_as_of(spark, sf):
    """The store as it was at one time, from the written intervals."""
    path = scratch_path(spark, "intervals")
    HI.validity(C._deliveries(spark, sf), SEQ).write.parquet(path)
    return HI.orders_as_of(spark.read.parquet(path), F.lit(HISTORY_AT).cast("timestamp")).select(C._UPSERT_COLS)


@register("versions_at", O.with_(
    "SELECT m.orderId, m.at, v.status, v.totalAmount FROM (SELECT orderId, eventTimestamp + INTERVAL '30' MINUTE * (CAST(kafkaOffset AS INT) % 4 - 1) AS at "
    "FROM order_docs) m LEFT JOIN validity v ON v.orderId = m.orderId AND v.validFrom <= m.at AND (v.validTo IS NULL OR v.validTo > m.at)",
    DOCS, DELIVERIES, VALIDITY_SQL))
def q_versions_at(spark, sf):
    """For every order the version current at a time of its own: before, at and after its arrivals."""
    half_hours = F.make_interval(mins=((F.col("kafkaOffset") % 4).cast("int") - 1) * 30)
    moments = C._docs(spark, sf).select("orderId", (F.col("eventTimestamp") + half_hours).alias("at"))
    return HI.versions_at(moments, HI.validity(C._deliveries(spark, sf), SEQ)).select("orderId", "at", "status", "totalAmount")


# -------------------------------------------------------------------------- F1
DEEP_PAGE, DEEP_SIZE = 70, 20
SEEK_TIME, SEEK_ID = "1996-01-02 10:00:00", "ORD-00000100"
_DIRECTORIES: dict[tuple[str, str], str] = {}


def _directory(spark, sf) -> DataFrame:
    """The page directory of the stored orders, written once a Spark application and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DIRECTORIES:
        path = scratch_path(spark, "page_directory")
        PG.write_directory(spark, C._stored(spark, sf), path)
        _DIRECTORIES[key] = path
    return spark.read.parquet(_DIRECTORIES[key])


@register("page_by_position", O.with_(f"SELECT * FROM order_docs {ORDER_P1} LIMIT {DEEP_SIZE} OFFSET {DEEP_PAGE * DEEP_SIZE}", DOCS))
def q_page_by_position(spark, sf):
    """F1, a deep page by the directory of row counts: reads the hours it falls in."""
    return PG.page_by_position(C._stored(spark, sf), _directory(spark, sf), DEEP_PAGE, DEEP_SIZE).select(*DOC_COLS)


@register("page_after", O.with_(
    f"SELECT * FROM order_docs WHERE eventTimestamp < TIMESTAMP '{SEEK_TIME}' OR (eventTimestamp = TIMESTAMP '{SEEK_TIME}' AND "
    f"orderId > '{SEEK_ID}') OR eventTimestamp IS NULL {ORDER_P1} LIMIT {DEEP_SIZE}", DOCS))
def q_page_after(spark, sf):
    """F1, the rows after a given one, by a seek predicate."""
    return PG.page_after(C._stored(spark, sf), SEEK_TIME, SEEK_ID, DEEP_SIZE).select(*DOC_COLS)


# ------------------------------------------------------------------ D5, D6, D12
ROLLING_AT = "TIMESTAMP '2001-07-15 10:20:30'"
BATCHES = 4
_ROLLUPS: dict[tuple[str, str], str] = {}


def _rollups(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(partials, stored lifecycle orders): the partials were left by batches of orders, one of them changed twice."""
    store = C._stored_lc(spark, sf)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ROLLUPS:
        root = scratch_path(spark, "rollups")
        lane = F.pmod(F.xxhash64("orderId"), F.lit(BATCHES))
        for k in range(BATCHES):
            rows = store.where(lane == k)
            if k == 0:  # arrived as PLACED, then as they are now: the second batch leaves the difference
                first = rows.withColumn("status", F.lit("PLACED"))
                RU.write_partials(RU.hourly_partials(first), root, BATCHES)
                RU.write_partials(RU.change(first, rows), root, k)
            else:
                RU.write_partials(RU.hourly_partials(rows), root, k)
        _ROLLUPS[key] = root
    return RU.read_partials(spark, _ROLLUPS[key]), store


@register("resync_24h_rollup", C.ORACLE["resync_24h"].replace(O.AS_OF, ROLLING_AT))
def q_resync_24h_rollup(spark, sf):
    """D12 at a time within an hour, from hourly partials and the rows of two hours."""
    partials, store = _rollups(spark, sf)
    r = RU.resync(partials, store, F.expr(ROLLING_AT), 24)
    return r.withColumn("statusCounts", F.to_json("statusCounts"))


@register("hourly_stats_rollup", C.ORACLE["hourly_stats"].replace(C.HOURLY_SINCE, "2001-07-03 10:20:30"))
def q_hourly_stats_rollup(spark, sf):
    """D5 since a time within an hour, from hourly partials and the rows of that hour."""
    partials, store = _rollups(spark, sf)
    return RU.hourly_stats(partials, store, F.lit("2001-07-03 10:20:30").cast("timestamp"))


# --------------------------------------------------------------------- B12 / C1
_TABLES: dict[tuple[str, str], str] = {}


@register("orders_exist_bucketed", C.ORACLE["orders_exist"])
def q_orders_exist_bucketed(spark, sf):
    """B12 on ids stored in buckets: only the asked ids are shuffled."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TABLES:
        _TABLES[key] = ST.write_id_table(C._docs(spark, sf), scratch_path(spark, "order_ids"))
    ids = FX.table(spark, sf, "customer").select(F.concat(F.lit("ORD-"), X.padded(F.col("c_custkey") * 13, 8)).alias("orderId"))
    return L.orders_exist_bucketed(ids, spark.table(_TABLES[key]))


