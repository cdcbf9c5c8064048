"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over the
whole test tables (no id subsets, no row caps; a ``limit`` appears only where
paging / top-k is the operator).  ``oracle_sql`` holds the DuckDB twin of each
batch query; the streaming entries live in ``orderflow.streaming.catalog``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import scalars as X
from orderflow.operators import documents as D
from orderflow.operators import feed as FD
from orderflow.operators import lookup as L
from orderflow.operators import metrics as M
from orderflow.operators import retry as R
from orderflow.operators import store as ST
from orderflow.operators import validate as V
from orderflow.plans import oracle as O
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ------------------------------------------------------------------ params
AS_OF = FX.AS_OF
DOC_COLS = ["orderId", "customerId", "customerTier", "status", "totalAmount", "currency", "region",
            "paymentMethod", "processingStatus", "retryCount", "priority", "category", "lifecycleStatus",
            "eventTimestamp", "kafkaOffset"]
LC_COLS = ["orderId", "customerId", "status", "priority", "region", "category", "totalAmount", "currency",
           "retryCount", "createdAt", "kafkaOffset"]
DOCS, LC, ITEMS = O.ORDER_DOCS, O.LIFECYCLE, O.ITEMS
ORDER_P1 = "ORDER BY eventTimestamp DESC NULLS LAST, orderId"
ORDER_P2 = "ORDER BY createdAt DESC NULLS LAST, orderId"

LOOKUP_ID = "ORD-00000042"
LOOKUP_CUSTOMER = "CUST-0010"
BETWEEN_FROM, BETWEEN_TO = "1998-01-01 00:00:00", "1998-03-01 00:00:00"
RANGE_FROM, RANGE_TO = "1999-06-01 00:00:00", "1999-06-30 23:59:59"
SINCE_CATEGORIES = "2000-01-01 00:00:00"
HOURLY_SINCE = "2001-07-03 00:00:00"  # AS_OF - 30 days
CHART_HOURS = 720


def _docs(spark, sf):
    return FX.order_docs(spark, sf)


def _lc(spark, sf):
    return FX.lifecycle_orders(FX.order_docs(spark, sf))


_STORES: dict[tuple[str, str], str] = {}


def _stored(spark, sf) -> DataFrame:
    """The orders in the store's layout (month folders, clustered files, Bloom
    filters on ids), written once a Spark application and input.  Lookups run on
    it: their filters reach the folders and the Parquet scan."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        path = scratch_path(spark, "store")
        ST.write_store(_docs(spark, sf), path, grain="month")
        _STORES[key] = path
    return ST.scan_orders(spark, _STORES[key])


def stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The store that the lookups read."""
    return _stored(spark, sf)


def forget_stores() -> None:
    """The next lookup writes its store anew."""
    _STORES.clear()


def _stored_lc(spark, sf) -> DataFrame:
    return FX.lifecycle_orders(_stored(spark, sf))


def _ts(v: str):
    return F.lit(v).cast("timestamp")


# =========================================================== scalars / lanes
@register("partition_key", O.with_(
    "SELECT orderId, customerTier || ':' || customerId AS key FROM order_docs", DOCS))
def q_partition_key(spark, sf):
    return _docs(spark, sf).select("orderId", X.partition_key("customerTier", "customerId").alias("key"))


@register("tier_lane", O.with_(
    f"SELECT orderId, key, {O.tier_lane('key')} AS lane FROM "
    "(SELECT orderId, customerTier || ':' || customerId AS key FROM order_docs)", DOCS))
def q_tier_lane(spark, sf):
    d = _docs(spark, sf).select("orderId", X.partition_key("customerTier", "customerId").alias("key"))
    return d.select("orderId", "key", X.tier_lane(F.col("key")).alias("lane"))


@register("priority_lane", O.with_(
    f"SELECT orderId, key, {O.priority_lane('key')} AS lane, {O.priority_lane('key', 3)} AS lane3 FROM "
    "(SELECT orderId, priority || ':' || customerId AS key FROM order_docs)", DOCS))
def q_priority_lane(spark, sf):
    d = _docs(spark, sf).select("orderId", X.partition_key("priority", "customerId").alias("key"))
    prio, cust = X.priority_key_parts(F.col("key"))
    h = d.select("orderId", "key", prio.alias("_p"), X.java_abs_hash(cust).alias("_h"))  # hash once
    return h.select("orderId", "key", X.priority_lane_of(F.col("_p"), F.col("_h")).alias("lane"),
                    X.priority_lane_of(F.col("_p"), F.col("_h"), 3).alias("lane3"))


@register("java_string_hash",
          f"SELECT c_custkey, c_name, {O.jhash('c_name')} AS hashCode, {O.jabs('c_name')} AS absHash FROM customer")
def q_java_string_hash(spark, sf):
    c = FX.table(spark, sf, "customer").select("c_custkey", "c_name")
    return c.select("c_custkey", "c_name", X.java_string_hash("c_name").alias("hashCode"),
                    X.java_abs_hash("c_name").alias("absHash"))


@register("publish_ack", O.with_(
    f"SELECT '{S.PUBLISH_ACK_MESSAGE}' AS message, orderId, customerTier AS tier, "
    f"CASE WHEN customerTier = 'PREMIUM' THEN '{S.PREMIUM_ROUTE_LABEL}' ELSE '{S.STANDARD_ROUTE_LABEL}' END "
    "AS routing FROM order_docs", DOCS))
def q_publish_ack(spark, sf):
    return D.publish_ack(_docs(spark, sf))


@register("routing_label", O.with_(
    "SELECT orderId, customerTier AS tier, "
    f"CASE WHEN customerTier = 'PREMIUM' THEN '{S.PREMIUM_ROUTE_LABEL}' ELSE '{S.STANDARD_ROUTE_LABEL}' END "
    "AS routing FROM order_docs", DOCS))
def q_routing_label(spark, sf):
    """The routing label of every order (lane 0 for PREMIUM)."""
    return _docs(spark, sf).select("orderId", F.col("customerTier").alias("tier"),
                                   X.routing_label("customerTier").alias("routing"))


_LC_LIST = ", ".join(f"'{x}'" for x in S.LIFECYCLE_STATUSES)


@register("normalize_enum", O.with_(
    "SELECT orderId, lower(status) AS rawStatus, "
    f"CASE WHEN upper(lower(status)) IN ({_LC_LIST}) THEN upper(lower(status)) END AS status, "
    f"upper(lower(status)) IN ({_LC_LIST}) AS isValid FROM order_docs", DOCS))
def q_normalize_enum(spark, sf):
    """H3: P1 statuses as lower-case text checked against the P2 status list
    (upper-cased; unknown values such as CONFIRMED become null)."""
    d = _docs(spark, sf).select("orderId", F.lower("status").alias("rawStatus"))
    norm = X.normalize_enum(F.col("rawStatus"), S.LIFECYCLE_STATUSES)
    return d.select("orderId", "rawStatus", norm.alias("status"), norm.isNotNull().alias("isValid"))


@register("order_id", "SELECT count(*) AS total, count(*) AS wellFormed, count(*) AS distinctIds FROM orders")
def q_order_id(spark, sf):
    """H4: a fresh 128-bit id for every order: all well-formed, no two alike."""
    ids = FX.table(spark, sf, "orders").select(X.order_id(32).alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("id").rlike("^ORD-[0-9A-F]{32}$")).alias("wellFormed"),
                   F.countDistinct("id").alias("distinctIds"))


# ================================================================ validation
def _blank(c: str) -> str:
    return f"({c} IS NULL OR regexp_matches({c}, '^[\\x00-\\x20]*$'))"


FAULTY = """faulty AS (
SELECT orderId, CASE WHEN kafkaOffset % 13 = 0 THEN ' ' ELSE customerId END AS customerId, customerTier, status,
 CASE WHEN kafkaOffset % 17 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN kafkaOffset % 19 = 0 THEN NULL
      ELSE totalAmount END AS totalAmount, currency, region, paymentMethod, eventTimestamp, kafkaOffset
FROM order_docs)"""

_EVENT_ERRORS = (
    "NULLIF(concat_ws(', ', "
    f"CASE WHEN {_blank('orderId')} THEN 'orderId: {S.MSG_NOT_BLANK}' END, "
    f"CASE WHEN {_blank('customerId')} THEN 'customerId: {S.MSG_NOT_BLANK}' END, "
    f"CASE WHEN {_blank('customerTier')} THEN 'customerTier: {S.MSG_NOT_BLANK}' END, "
    f"CASE WHEN {_blank('status')} THEN 'status: {S.MSG_NOT_BLANK}' END, "
    f"CASE WHEN totalAmount IS NULL THEN 'totalAmount: {S.MSG_NOT_NULL}' END, "
    f"CASE WHEN totalAmount < 0.01 THEN 'totalAmount: {S.MSG_MIN_AMOUNT}' END, "
    f"CASE WHEN {_blank('currency')} THEN 'currency: {S.MSG_NOT_BLANK}' END, "
    f"CASE WHEN {_blank('region')} THEN 'region: {S.MSG_NOT_BLANK}' END), '')"
)


@register("validate_events", O.with_(
    f"SELECT orderId, errorText, errorText IS NULL AS isValid FROM (SELECT orderId, {_EVENT_ERRORS} AS errorText "
    "FROM faulty)", DOCS, FAULTY))
def q_validate_events(spark, sf):
    return V.validate_events(FX.faulty_orders(spark, sf)).select("orderId", "errorText", "isValid")


@register("split_valid", O.with_(
    f"SELECT orderId, customerId, totalAmount FROM faulty WHERE {_EVENT_ERRORS} IS NULL", DOCS, FAULTY))
def q_split_valid(spark, sf):
    ok, _rejected = V.split_valid(V.validate_events(FX.faulty_orders(spark, sf)))
    return ok.select("orderId", "customerId", "totalAmount")


_M = S.REQUEST_MESSAGES
REQUESTS = """requests AS (
SELECT d.orderId AS requestId, CASE WHEN d.kafkaOffset % 13 = 0 THEN ' ' ELSE d.customerId END AS customerId,
 'Customer ' || d.customerId AS customerName, d.priority, d.region, d.category, i.items, d.kafkaOffset,
 CASE WHEN d.kafkaOffset % 17 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN d.kafkaOffset % 19 = 0 THEN NULL
      ELSE d.totalAmount END AS totalAmount
FROM order_docs d LEFT JOIN items i ON d.kafkaOffset = i.l_orderkey)"""
_REQUEST_ERRORS = (
    "NULLIF(concat_ws(', ', "
    f"CASE WHEN {_blank('customerId')} THEN 'customerId: {_M['customerId']}' END, "
    f"CASE WHEN {_blank('customerName')} THEN 'customerName: {_M['customerName']}' END, "
    f"CASE WHEN priority IS NULL THEN 'priority: {_M['priority']}' END, "
    f"CASE WHEN {_blank('region')} THEN 'region: {_M['region']}' END, "
    f"CASE WHEN {_blank('category')} THEN 'category: {_M['category']}' END, "
    f"CASE WHEN coalesce(len(items), 0) = 0 THEN 'items: {_M['items']}' END, "
    f"CASE WHEN totalAmount IS NULL THEN 'totalAmount: {S.MSG_NOT_NULL}' END, "
    f"CASE WHEN totalAmount < 0.01 THEN 'totalAmount: {_M['totalAmount_min']}' END), '')"
)


@register("validate_requests", O.with_(
    f"SELECT requestId, errorText, errorText IS NULL AS isValid FROM "
    f"(SELECT requestId, {_REQUEST_ERRORS} AS errorText FROM requests)", DOCS, ITEMS, REQUESTS))
def q_validate_requests(spark, sf):
    return V.validate_requests(FX.order_requests(spark, sf)).select("requestId", "errorText", "isValid")


@register("place_orders", O.with_(
    "SELECT requestId, true AS idOk, customerId, 'PLACED' AS status, priority, region, totalAmount, "
    f"'{S.DEFAULT_CURRENCY}' AS currency, CASE WHEN kafkaOffset % 4 = 0 THEN '{S.DEFAULT_SOURCE_SYSTEM}' ELSE 'WEB' END "
    f"AS sourceSystem, 0 AS retryCount FROM requests WHERE {_REQUEST_ERRORS} IS NULL", DOCS, ITEMS, REQUESTS))
def q_place_orders(spark, sf):
    """The placed order of every valid request; of the fresh id its form."""
    ok, _ = V.split_valid(V.validate_requests(FX.order_requests(spark, sf)))
    return D.place_orders(ok, keep=["requestId"]).select(
        "requestId", F.col("orderId").rlike("^ORD-[0-9A-F]{8}$").alias("idOk"), "customerId", "status", "priority", "region",
        "totalAmount", "currency", "sourceSystem", "retryCount")


# ============================================================ records / JSON
EVENTS_JOIN = "order_docs d LEFT JOIN items i ON d.kafkaOffset = i.l_orderkey"
DOC_KEY = "(d.customerTier || ':' || d.customerId)"
TOPIC_LOG = f"""topic_log AS (
SELECT d.customerTier || ':' || d.customerId AS key,
 CASE WHEN d.kafkaOffset % 101 = 0 THEN CASE (d.kafkaOffset // 101) % 7
      WHEN 0 THEN substring({O.EVENT_JSON}, 1, length({O.EVENT_JSON}) // 2) WHEN 1 THEN '' WHEN 2 THEN '  '
      WHEN 3 THEN 'null' WHEN 4 THEN '[]' WHEN 5 THEN '123' ELSE NULL END
      ELSE {O.EVENT_JSON} END AS value,
 '{S.ORDER_TOPIC}' AS topic, d.kafkaOffset AS "offset", d.eventTimestamp AS "timestamp"
FROM {EVENTS_JOIN})"""


@register("publish_orders", O.with_(
    f"SELECT key, value, {O.tier_lane('key')} AS partition FROM (SELECT d.customerTier || ':' || d.customerId "
    f"AS key, {O.EVENT_JSON} AS value FROM {EVENTS_JOIN})", DOCS, ITEMS))
def q_publish_orders(spark, sf):
    return D.to_topic_records(FX.order_events(spark, sf), routing="tier")


_P2_FIELDS = ["orderId", "customerId", "status", "priority", "region", "category", "totalAmount", "currency", "retryCount"]


@register("publish_priority", O.with_(
    f"SELECT key, value, {O.priority_lane('key')} AS partition FROM (SELECT priority || ':' || customerId AS key, "
    f"CAST(to_json(struct_pack({', '.join(f'{c} := {c}' for c in _P2_FIELDS)})) AS VARCHAR) AS value FROM lifecycle)", DOCS, LC))
def q_publish_priority(spark, sf):
    """P2 publish: key ``priority:customerId``, eight lanes in priority bands."""
    return D.to_topic_records(_lc(spark, sf), routing="priority", fields=_P2_FIELDS)


MAX_BYTES = 900


@register("publish_outcomes", O.with_(
    f"SELECT key, CASE WHEN strlen(value) > {MAX_BYTES} THEN 'record too large' END AS publishError, "
    f"strlen(value) <= {MAX_BYTES} AS published FROM (SELECT {DOC_KEY} AS key, {O.EVENT_JSON} AS value FROM {EVENTS_JOIN})",
    DOCS, ITEMS))
def q_publish_outcomes(spark, sf):
    """Per record, whether a topic that takes small records only takes it."""
    records = D.to_topic_records(FX.order_events(spark, sf), routing="tier")
    return D.publish_outcome(records, MAX_BYTES).select("key", "publishError", "published")


@register("publish_counters", O.with_(
    f"SELECT count(*) FILTER (WHERE ok) AS published, count(*) FILTER (WHERE NOT ok) AS publishFailed, CAST(0 AS BIGINT) AS "
    f"processed, CAST(0 AS BIGINT) AS deadLettered FROM (SELECT strlen({O.EVENT_JSON}) <= {MAX_BYTES} AS ok FROM {EVENTS_JOIN})",
    DOCS, ITEMS))
def q_publish_counters(spark, sf):
    """D19's publish side, counted over each record's outcome."""
    return M.flow_counters(q_publish_outcomes(spark, sf).select(F.lit("publish").alias("stage"), F.col("published").alias("ok")))


def _parsed(spark, sf):
    return D.parse_orders(FX.topic_log(spark, sf))


@register("parse_orders", O.with_(
    "SELECT d.kafkaOffset AS \"offset\", d.kafkaOffset % 101 = 0 AS parseError, "
    + ", ".join(f"CASE WHEN d.kafkaOffset % 101 <> 0 THEN d.{c} END AS {c}" for c in
                ["orderId", "customerId", "customerTier", "status", "totalAmount", "currency", "region",
                 "paymentMethod", "eventTimestamp", "retryCount"])
    + ", CASE WHEN d.kafkaOffset % 101 <> 0 THEN coalesce(i.itemCount, 0) END AS itemCount "
    f"FROM {EVENTS_JOIN}", DOCS, ITEMS))
def q_parse_orders(spark, sf):
    p = _parsed(spark, sf)
    return p.select(
        "offset", "parseError",
        *[F.col(f"event.{c}").alias(c) for c in ["orderId", "customerId", "customerTier", "status", "totalAmount",
                                                  "currency", "region", "paymentMethod", "eventTimestamp",
                                                  "retryCount"]],
        F.when(~F.col("parseError"), X.item_count(F.col("event.items"))).alias("itemCount"),
    )


@register("quarantine", O.with_(
    f"SELECT topic, {O.tier_lane('key')} AS partition, \"offset\", substring(value, 1, 200) AS rawPrefix, "
    "value AS rawValue FROM topic_log WHERE \"offset\" % 101 = 0", DOCS, ITEMS, TOPIC_LOG))
def q_quarantine(spark, sf):
    return D.quarantine(_parsed(spark, sf))


@register("order_documents", O.with_(
    f"SELECT d.orderId, {O.tier_lane(DOC_KEY)} AS kafkaPartition, "
    f"d.kafkaOffset, '{S.ORDER_TOPIC}' AS kafkaTopic, 'SUCCESS' AS processingStatus, d.retryCount, "
    "d.eventTimestamp, coalesce(i.itemCount, 0) AS itemCount, coalesce(i.itemsTotal, 0) AS itemsTotal "
    f"FROM {EVENTS_JOIN} WHERE d.kafkaOffset % 101 <> 0", DOCS, ITEMS))
def q_order_documents(spark, sf):
    p = _parsed(spark, sf).filter(~F.col("parseError"))
    docs = D.to_order_document(D.flatten_event(p, ["partition", "offset", "topic"]), "SUCCESS", FX.as_of())
    return docs.select("orderId", "kafkaPartition", "kafkaOffset", "kafkaTopic", "processingStatus", "retryCount",
                       "eventTimestamp", F.size("items").alias("itemCount"),
                       F.coalesce(X.items_total(F.col("items")), F.lit(0).cast(S.AMOUNT))
                       .cast("decimal(38,2)").alias("itemsTotal"))


# ----------------------------------------------------------- retry routing
def _fails(parse_error_col: str = "parseError"):
    """A record fails an attempt when it does not parse, or on the planted
    transient failures of the retry fixture."""
    m = F.col("offset") % 50
    return lambda a: F.col(parse_error_col) | ((m < 6) & (a <= m))


def _attempts(spark, sf):
    return R.attempts_of(_parsed(spark, sf), _fails())


def _routed(spark, sf):
    return R.route_failures(_attempts(spark, sf), "ok", "attempt", FX.as_of())


# SQL twin of the attempt fan-out: attempts 1..first success (or 1..4)
ATTEMPTS = """attempts AS (
SELECT t.*, CAST(a.attempt AS INT) AS attempt,
 (t."offset" % 101 <> 0) AND NOT (t."offset" % 50 < 6 AND a.attempt <= t."offset" % 50) AS ok
FROM topic_log t, range(1, 5) a(attempt)
WHERE a.attempt <= CASE WHEN t."offset" % 101 = 0 THEN 4
                         WHEN t."offset" % 50 < 6 AND t."offset" % 50 >= 4 THEN 4
                         WHEN t."offset" % 50 < 6 THEN greatest(t."offset" % 50 + 1, 1)
                         ELSE 1 END)"""
ROUTED = f"""routed AS (
SELECT *, CASE WHEN attempt < 4 THEN topic || '-retry-' || CAST(attempt - 1 AS VARCHAR) ELSE topic || '-dlt' END
   AS nextTopic,
 CASE WHEN attempt < 4 THEN attempt + 1 END AS nextAttempt,
 CAST(CASE WHEN attempt < 4 THEN least(2000 * pow(2, attempt - 1), 30000) ELSE 0 END AS BIGINT) AS delayMs,
 attempt >= 4 AS deadLetter
FROM attempts WHERE NOT ok)"""


@register("retry_route", O.with_(
    f"SELECT \"offset\", attempt, nextTopic, CAST(nextAttempt AS INT) AS nextAttempt, delayMs, "
    f"{O.AS_OF} + delayMs * INTERVAL '1' MILLISECOND AS dueAt, deadLetter FROM routed",
    DOCS, ITEMS, TOPIC_LOG, ATTEMPTS, ROUTED))
def q_retry_route(spark, sf):
    return _routed(spark, sf).select("offset", "attempt", "nextTopic", "nextAttempt", "delayMs", "dueAt",
                                     "deadLetter")


@register("backoff_schedule", O.with_(
    "SELECT attempt, nextTopic, delayMs, count(*) AS failures FROM routed GROUP BY attempt, nextTopic, delayMs",
    DOCS, ITEMS, TOPIC_LOG, ATTEMPTS, ROUTED))
def q_backoff_schedule(spark, sf):
    return (_routed(spark, sf).groupBy("attempt", "nextTopic", "delayMs")
            .agg(F.count(F.lit(1)).alias("failures")))


@register("with_due_retries", O.with_(
    "SELECT \"offset\", topic, 1 AS attempt FROM topic_log UNION ALL "
    "SELECT \"offset\", topic, nextAttempt AS attempt FROM routed WHERE attempt = 1 AND delayMs <= 3000",
    DOCS, ITEMS, TOPIC_LOG, ATTEMPTS, ROUTED))
def q_with_due_retries(spark, sf):
    """One micro-batch 3 s after ``AS_OF``: new records (attempt 1) plus the
    first-attempt failures whose retry is due by then."""
    log = FX.topic_log(spark, sf)
    batch = log.select("offset", "topic", F.lit(1).alias("attempt"))
    first = R.attempts_of(D.parse_orders(log), _fails()).filter(F.col("attempt") == 1)
    retries = R.route_failures(first, "ok", "attempt", FX.as_of()).select(
        "offset", "topic", F.col("nextAttempt").alias("attempt"), "dueAt")
    now = FX.as_of() + F.expr("INTERVAL 3 SECONDS")
    return R.with_due_retries(batch, retries, now)


DEAD = """dead AS (SELECT * FROM routed WHERE deadLetter)"""


def dead_letter_records(spark, sf) -> DataFrame:
    """Records that exhausted every attempt, as records of the dead-letter
    topic (same key, value, partition and offset)."""
    r = _routed(spark, sf).filter("deadLetter")
    return r.select("key", "value", F.col("nextTopic").alias("topic"), "partition", "offset", "timestamp")


@register("dead_letter_sink", O.with_(
    f"SELECT d.orderId, 4 AS retryCount, '{S.DLQ_ERROR}' AS lastError, 'DLQ' AS processingStatus, "
    f"'{S.ORDER_TOPIC}-dlt' AS kafkaTopic, {O.tier_lane(DOC_KEY)} "
    "AS kafkaPartition, d.kafkaOffset FROM order_docs d "
    "WHERE d.kafkaOffset % 50 IN (4, 5) AND d.kafkaOffset % 101 <> 0", DOCS))
def q_dead_letter_sink(spark, sf):
    parsed = D.parse_orders(dead_letter_records(spark, sf))
    stamped = D.stamp_dead_letters(parsed)
    docs = D.to_order_document(stamped, "DLQ", FX.as_of())
    return docs.select("orderId", "retryCount", "lastError", "processingStatus", "kafkaTopic", "kafkaPartition",
                       "kafkaOffset")


@register("dead_letter_quarantine", O.with_(
    "SELECT topic || '-dlt' AS topic, \"offset\", substring(value, 1, 200) AS rawPrefix FROM topic_log "
    "WHERE \"offset\" % 101 = 0", DOCS, ITEMS, TOPIC_LOG))
def q_dead_letter_quarantine(spark, sf):
    """A6 on the dead-letter consumer: dead letters that do not parse."""
    q = D.quarantine(D.parse_orders(dead_letter_records(spark, sf)))
    return q.select("topic", "offset", "rawPrefix")


@register("flow_counters", O.with_(
    "SELECT (SELECT count(*) FROM topic_log) AS published, CAST(0 AS BIGINT) AS publishFailed, "
    "(SELECT count(*) FROM attempts WHERE ok) AS processed, (SELECT count(*) FROM routed WHERE deadLetter) "
    "AS deadLettered", DOCS, ITEMS, TOPIC_LOG, ATTEMPTS, ROUTED))
def q_flow_counters(spark, sf):
    att = _attempts(spark, sf)
    outcomes = att.select(
        F.explode(F.array(
            F.when(F.col("attempt") == 1, F.struct(F.lit("publish").alias("stage"), F.lit(True).alias("ok"))),
            F.struct(F.lit("consume").alias("stage"), F.col("ok").alias("ok")),
            F.when((F.col("attempt") == S.MAX_ATTEMPTS) & ~F.col("ok"),
                   F.struct(F.lit("dead_letter").alias("stage"), F.lit(False).alias("ok"))),
        )).alias("o")).filter(F.col("o").isNotNull()).select("o.*")
    return M.flow_counters(outcomes)


# =================================================================== store
DELIVERIES = """deliveries AS (
SELECT orderId, customerId, 'PLACED' AS status, totalAmount, 1 AS delivery, kafkaOffset AS seq, eventTimestamp AS ingestedAt
FROM order_docs
UNION ALL
SELECT orderId, customerId, 'CANCELLED' AS status, CAST(totalAmount + 1 AS DECIMAL(18,2)) AS totalAmount,
 2 AS delivery, kafkaOffset AS seq, eventTimestamp + INTERVAL 1 HOUR AS ingestedAt
FROM order_docs WHERE kafkaOffset % 10 = 0)"""


UPSERT_SQL = O.with_(
    "SELECT substr(sha256(orderId || ':' || CAST(firstDelivery AS VARCHAR) || ':' || CAST(seq AS VARCHAR)), 1, 24) AS id, orderId, "
    "customerId, status, totalAmount, delivery, seq, createdAt, updatedAt FROM (SELECT *, row_number() OVER (PARTITION BY orderId "
    "ORDER BY delivery DESC) AS rn, min(ingestedAt) OVER (PARTITION BY orderId) AS createdAt, ingestedAt AS updatedAt, "
    "min(delivery) OVER (PARTITION BY orderId) AS firstDelivery FROM deliveries) WHERE rn = 1", DOCS, DELIVERIES)
_UPSERT_COLS = ["id", "orderId", "customerId", "status", "totalAmount", "delivery", "seq", "createdAt", "updatedAt"]


def _deliveries(spark, sf):
    return FX.deliveries(spark, sf).select("orderId", "customerId", "status", "totalAmount", "delivery", "seq", "ingestedAt")


@register("upsert_orders", UPSERT_SQL)
def q_upsert_orders(spark, sf):
    return ST.upsert_orders(_deliveries(spark, sf), ["delivery", "seq"]).select(_UPSERT_COLS)


@register("merge_store", UPSERT_SQL)
def q_merge_store(spark, sf):
    """A4 in two batches: the second deliveries first, written as a snapshot,
    then the first ones, which arrive late; the outcome is the same."""
    log, seq = _deliveries(spark, sf), ["delivery", "seq"]
    root = scratch_path(spark, "merge_store")
    state = ST.upsert_orders(log.filter("delivery = 2"), seq, keep_state=True)
    ST.compact_store(spark, state, root)
    return ST.merge_into_store(ST.read_snapshot(spark, root), log.filter("delivery = 1"), seq).select(_UPSERT_COLS)


@register("page_orders", O.with_(f"SELECT * FROM order_docs {ORDER_P1} LIMIT 20 OFFSET 60", DOCS))
def q_page_orders(spark, sf):
    """page 3 (size 20) of all orders, newest first."""
    return L.page_orders(_stored(spark, sf), "eventTimestamp", 3, 20).select(*DOC_COLS)


@register("scan_orders", O.with_(f"SELECT * FROM order_docs {ORDER_P1} LIMIT 20", DOCS))
def q_scan_orders(spark, sf):
    return L.page_orders(_stored(spark, sf), "eventTimestamp", 0, 20).select(*DOC_COLS)


@register("retention_90d", O.with_(
    f"SELECT orderId, eventTimestamp FROM order_docs WHERE eventTimestamp IS NULL OR "
    f"eventTimestamp > {O.AS_OF} - INTERVAL '7776000' SECOND", DOCS))
def q_retention_90d(spark, sf):
    return ST.apply_retention(_docs(spark, sf), FX.as_of()).select("orderId", "eventTimestamp")


@register("retention_drop", O.with_(
    f"SELECT orderId, eventTimestamp FROM order_docs WHERE eventTimestamp IS NULL OR "
    f"eventTimestamp > {O.AS_OF} - INTERVAL '7776000' SECOND", DOCS))
def q_retention_drop(spark, sf):
    """A11 on the written store: expired folders are removed whole, and the
    expired rows of the folder that the cutoff falls into are hidden."""
    path = scratch_path(spark, "retention_store")
    ST.write_store(_docs(spark, sf), path, grain="month")
    ST.drop_expired(spark, path, AS_OF)
    return ST.apply_retention(ST.scan_orders(spark, path), FX.as_of()).select("orderId", "eventTimestamp")


# ==================================================================== feeds
def lean_sql(extra: str = "") -> str:
    return (
        "SELECT d.orderId, d.customerId, d.customerTier, d.status, d.totalAmount, d.currency, d.region, "
        f"coalesce(d.paymentMethod, '') AS paymentMethod, coalesce({O.iso('d.eventTimestamp')}, '') AS timestamp, "
        f"coalesce(i.itemCount, 0) AS itemCount{extra} FROM {EVENTS_JOIN} WHERE d.orderId IS NOT NULL AND "
        "d.customerId IS NOT NULL AND d.customerTier IS NOT NULL AND d.status IS NOT NULL AND d.totalAmount IS NOT "
        "NULL AND d.currency IS NOT NULL AND d.region IS NOT NULL")


LEAN_SQL = lean_sql()
FEED = f"feed AS ({LEAN_SQL})"


def _feed(spark, sf):
    return FD.lean_order(FX.order_events(spark, sf))


@register("live_feed", O.with_(LEAN_SQL, DOCS, ITEMS))
def q_live_feed(spark, sf):
    return _feed(spark, sf)


LIFECYCLE_FEED_SQL = (
    "SELECT orderId, customerId, '' AS customerName, status, priority, region, category, totalAmount, currency, "
    f"partition, coalesce({O.iso('createdAt')}, '') AS timestamp FROM (SELECT *, "
    f"{O.priority_lane("(priority || ':' || customerId)")} AS partition FROM lifecycle) "
    "WHERE orderId IS NOT NULL AND customerId IS NOT NULL AND status IS NOT NULL AND priority IS NOT NULL AND "
    "region IS NOT NULL AND category IS NOT NULL AND totalAmount IS NOT NULL AND currency IS NOT NULL")


@register("lifecycle_feed", O.with_(LIFECYCLE_FEED_SQL, DOCS, LC))
def q_lifecycle_feed(spark, sf):
    lc = _lc(spark, sf).withColumn("customerName", F.lit(None).cast("string"))
    return FD.lean_lifecycle(lc)


def _json_sql(columns: list[str], source: str) -> str:
    return f"SELECT CAST(to_json(struct_pack({', '.join(f'{c} := {c}' for c in columns)})) AS VARCHAR) AS payload FROM ({source})"


@register("live_feed_json", O.with_(_json_sql([*FD.LEAN_REQUIRED, "paymentMethod", "timestamp", "itemCount"], LEAN_SQL), DOCS, ITEMS))
def q_live_feed_json(spark, sf):
    """The payload of each feed row."""
    return FD.feed_json(_feed(spark, sf))


@register("lifecycle_feed_json", O.with_(_json_sql(
    ["orderId", "customerId", "customerName", "status", "priority", "region", "category", "totalAmount", "currency", "partition",
     "timestamp"], LIFECYCLE_FEED_SQL), DOCS, LC))
def q_lifecycle_feed_json(spark, sf):
    """The payload of each lifecycle feed row."""
    return FD.feed_json(q_lifecycle_feed(spark, sf))


@register("recent_feed", O.with_(
    "SELECT orderId, customerTier, status, totalAmount, region, timestamp, arrival FROM "
    f"({lean_sql(', d.kafkaOffset AS arrival')}) ORDER BY arrival DESC LIMIT 50", DOCS, ITEMS))
def q_recent_feed(spark, sf):
    ev = FX.order_events(spark, sf).withColumnRenamed("kafkaOffset", "arrival")
    lean = FD.lean_order(ev, keep=["arrival"])
    return FD.recent_feed(lean, "arrival", 50).select("orderId", "customerTier", "status", "totalAmount", "region",
                                                      "timestamp", "arrival")


@register("session_totals", O.with_(
    "SELECT count(*) AS orders, count(*) FILTER (WHERE customerTier = 'PREMIUM') AS premium, "
    "count(*) FILTER (WHERE coalesce(customerTier, '') <> 'PREMIUM') AS standard, "
    "CAST(floor(coalesce(sum(totalAmount), 0) + 0.5) AS BIGINT) AS revenue, "
    "CASE WHEN count(*) > 0 THEN CAST(floor(coalesce(sum(totalAmount), 0) / count(*) + 0.5) AS BIGINT) ELSE 0 END "
    "AS avgOrder FROM feed", DOCS, ITEMS, FEED))
def q_session_totals(spark, sf):
    return M.session_totals(_feed(spark, sf))


@register("premium_split", O.with_(
    "SELECT premium, standard, CASE WHEN total > 0 THEN " + O.pct("premium", "total") + " ELSE 0 END AS premiumPct, "
    "CASE WHEN total > 0 THEN " + O.pct("standard", "total") + " ELSE 0 END AS standardPct FROM "
    "(SELECT count(*) AS total, count(*) FILTER (WHERE customerTier = 'PREMIUM') AS premium, "
    "count(*) FILTER (WHERE coalesce(customerTier, '') <> 'PREMIUM') AS standard FROM feed)", DOCS, ITEMS, FEED))
def q_premium_split(spark, sf):
    return M.premium_split(_feed(spark, sf))


def _share_sql(col: str) -> str:
    return O.with_(
        f"SELECT {col}, orders, {O.pct('orders', '(SELECT count(*) FROM feed)')} AS pct FROM "
        f"(SELECT {col}, count(*) AS orders FROM feed GROUP BY {col}) ORDER BY orders DESC, {col} NULLS FIRST",
        DOCS, ITEMS, FEED)


@register("region_share", _share_sql("region"))
def q_region_share(spark, sf):
    return M.region_share(_feed(spark, sf))


@register("payment_share", _share_sql("paymentMethod"))
def q_payment_share(spark, sf):
    return M.payment_share(_feed(spark, sf))


# ================================================================= lookups
def _page(where: str, order: str, page: int, size: int, src: str = "order_docs") -> str:
    return f"SELECT * FROM {src} WHERE {where} {order} LIMIT {size} OFFSET {page * size}"


@register("order_by_id", O.with_(f"SELECT * FROM order_docs WHERE orderId = '{LOOKUP_ID}'", DOCS))
def q_order_by_id(spark, sf):
    return L.get_order(_stored(spark, sf), LOOKUP_ID).select(*DOC_COLS)


@register("orders_exist", O.with_(
    "SELECT r.orderId, o.orderId IS NOT NULL AS \"exists\" FROM (SELECT 'ORD-' || lpad(CAST(c_custkey * 13 AS VARCHAR), "
    "CAST(greatest(8, length(CAST(c_custkey * 13 AS VARCHAR))) AS INT), '0') AS orderId FROM customer) r LEFT JOIN order_docs o ON r.orderId = o.orderId", DOCS))
def q_orders_exist(spark, sf):
    ids = FX.table(spark, sf, "customer").select(
        F.concat(F.lit("ORD-"), X.padded(F.col("c_custkey") * 13, 8)).alias("orderId"))
    return L.orders_exist(ids, _stored(spark, sf))


@register("orders_by_status", O.with_(_page("status = 'SHIPPED'", ORDER_P1, 2, 20), DOCS))
def q_orders_by_status(spark, sf):
    return L.orders_by_status(_stored(spark, sf), "SHIPPED", 2, 20).select(*DOC_COLS)


@register("lifecycle_by_status", O.with_(_page("status = 'DELIVERED'", ORDER_P2, 0, 20, "lifecycle"), DOCS, LC))
def q_lifecycle_by_status(spark, sf):
    return L.lifecycle_by_status(_stored_lc(spark, sf), "delivered", 0, 20).select(*LC_COLS)


@register("status_history", O.with_(f"SELECT * FROM lifecycle WHERE status = 'REFUNDED' {ORDER_P2}", DOCS, LC))
def q_status_history(spark, sf):
    return L.status_history(_stored_lc(spark, sf), "REFUNDED").select(*LC_COLS)


@register("orders_by_customer", O.with_(_page(f"customerId = '{LOOKUP_CUSTOMER}'", ORDER_P1, 0, 20), DOCS))
def q_orders_by_customer(spark, sf):
    return L.orders_by_customer(_stored(spark, sf), LOOKUP_CUSTOMER, 0, 20).select(*DOC_COLS)


@register("orders_by_region", O.with_(_page("region = 'EAST'", ORDER_P1, 1, 20), DOCS))
def q_orders_by_region(spark, sf):
    return L.orders_by_region(_stored(spark, sf), "EAST", 1, 20).select(*DOC_COLS)


@register("orders_by_tier", O.with_(_page("customerTier = 'PREMIUM'", ORDER_P1, 0, 20), DOCS))
def q_orders_by_tier(spark, sf):
    return L.orders_by_tier(_stored(spark, sf), "PREMIUM", 0, 20).select(*DOC_COLS)


@register("orders_between", O.with_(_page(
    f"eventTimestamp > TIMESTAMP '{BETWEEN_FROM}' AND eventTimestamp < TIMESTAMP '{BETWEEN_TO}'", ORDER_P1, 0, 50),
    DOCS))
def q_orders_between(spark, sf):
    return L.orders_between(_stored(spark, sf), BETWEEN_FROM, BETWEEN_TO, 0, 50).select(*DOC_COLS)


@register("orders_in_range", O.with_(
    f"SELECT * FROM lifecycle WHERE createdAt BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'", DOCS, LC))
def q_orders_in_range(spark, sf):
    return L.orders_in_range(_stored_lc(spark, sf), RANGE_FROM, RANGE_TO).select(*LC_COLS)


@register("orders_in_range_paged", O.with_(_page(
    f"createdAt BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'", ORDER_P2, 1, 20, "lifecycle"),
    DOCS, LC))
def q_orders_in_range_paged(spark, sf):
    return L.orders_in_range(_stored_lc(spark, sf), RANGE_FROM, RANGE_TO, 1, 20).select(*LC_COLS)


@register("status_in_range", O.with_(
    f"SELECT * FROM lifecycle WHERE status = 'SHIPPED' AND createdAt BETWEEN TIMESTAMP '{RANGE_FROM}' AND "
    f"TIMESTAMP '{RANGE_TO}'", DOCS, LC))
def q_status_in_range(spark, sf):
    return L.status_in_range(_stored_lc(spark, sf), "SHIPPED", RANGE_FROM, RANGE_TO).select(*LC_COLS)


@register("region_priority", O.with_(_page("region = 'EAST' AND priority = 'EXPRESS'", ORDER_P2, 0, 20,
                                           "lifecycle"), DOCS, LC))
def q_region_priority(spark, sf):
    return L.region_priority(_stored_lc(spark, sf), "east", "express", 0, 20).select(*LC_COLS)


@register("dlq_orders", O.with_("SELECT * FROM order_docs WHERE processingStatus = 'DLQ'", DOCS))
def q_dlq_orders(spark, sf):
    return L.by_processing_status(_stored(spark, sf), "DLQ").select(*DOC_COLS)


@register("failed_orders", O.with_("SELECT * FROM lifecycle WHERE status = 'FAILED' AND retryCount > 0", DOCS, LC))
def q_failed_orders(spark, sf):
    return L.failed_orders(_stored_lc(spark, sf)).select(*LC_COLS)


@register("search_orders", O.with_(_page("region = 'WEST'", ORDER_P1, 0, 20), DOCS))
def q_search_orders(spark, sf):
    """region and tier given: region wins (first-match precedence)."""
    return L.search_orders(_stored(spark, sf), region="WEST", tier="PREMIUM").select(*DOC_COLS)


def _search(key: str, where: str, **params):
    """One branch of the search; parameters of later branches are ignored."""
    @register(key, O.with_(_page(where, ORDER_P1, 0, 20), DOCS))
    def query(spark, sf):
        return L.search_orders(_stored(spark, sf), **params).select(*DOC_COLS)
    query.__name__ = f"q_{key}"


_search("search_by_status", "status = 'PLACED'", status="PLACED", customer_id=LOOKUP_CUSTOMER, region="WEST")
_search("search_by_customer", f"customerId = '{LOOKUP_CUSTOMER}'", customer_id=LOOKUP_CUSTOMER, region="WEST")
_search("search_by_tier", "customerTier = 'BASIC'", tier="BASIC", from_=BETWEEN_FROM, to=BETWEEN_TO)
_search("search_between", f"eventTimestamp > TIMESTAMP '{BETWEEN_FROM}' AND eventTimestamp < TIMESTAMP '{BETWEEN_TO}'",
        from_=BETWEEN_FROM, to=BETWEEN_TO)
_search("search_one_end", "true", from_=BETWEEN_FROM)
_search("search_all", "true")


@register("page_info", O.with_(
    "SELECT count(*) AS totalElements, CAST(ceil(count(*) / 20) AS BIGINT) AS totalPages, 20 AS size "
    "FROM order_docs WHERE status = 'SHIPPED'", DOCS))
def q_page_info(spark, sf):
    return L.page_info(_stored(spark, sf).filter(F.col("status") == "SHIPPED"), 20)


@register("customer_top10", O.with_(
    f"SELECT * FROM lifecycle WHERE customerId = '{LOOKUP_CUSTOMER}' {ORDER_P2} LIMIT 10", DOCS, LC))
def q_customer_top10(spark, sf):
    return L.customer_top(_stored_lc(spark, sf), LOOKUP_CUSTOMER, 10).select(*LC_COLS)


@register("recent_per_customer", O.with_(
    f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customerId {ORDER_P2}) AS INT) AS rank "
    "FROM lifecycle) WHERE rank <= 10", DOCS, LC))
def q_recent_per_customer(spark, sf):
    return L.recent_per_customer(_lc(spark, sf), 10).select(*LC_COLS, "rank")


# ============================================================ aggregations
@register("sales_summary", O.with_(
    f"SELECT totalOrders, totalRevenue, {O.exact_avg('totalRevenue', 'totalOrders')} AS avgOrderValue FROM "
    "(SELECT count(*) AS totalOrders, CAST(coalesce(sum(totalAmount), 0) AS DECIMAL(38,2)) AS totalRevenue "
    "FROM order_docs WHERE processingStatus = 'SUCCESS') WHERE totalOrders > 0", DOCS))
def q_sales_summary(spark, sf):
    return M.sales_summary(_docs(spark, sf))


@register("regional_sales", O.with_(
    "SELECT region, count(*) AS totalOrders, CAST(coalesce(sum(totalAmount), 0) AS DECIMAL(38,2)) AS totalRevenue "
    "FROM order_docs WHERE processingStatus = 'SUCCESS' GROUP BY region ORDER BY totalRevenue DESC", DOCS))
def q_regional_sales(spark, sf):
    return M.regional_sales(_docs(spark, sf))


@register("tier_distribution", O.with_(
    "SELECT customerTier, count(*) AS count, CAST(coalesce(sum(totalAmount), 0) AS DECIMAL(38,2)) AS revenue "
    "FROM order_docs GROUP BY customerTier ORDER BY revenue DESC", DOCS))
def q_tier_distribution(spark, sf):
    return M.tier_distribution(_docs(spark, sf))


@register("status_success_count", O.with_(
    "SELECT count(*) FILTER (WHERE status = 'DELIVERED' AND processingStatus = 'SUCCESS') AS orders "
    "FROM order_docs", DOCS))
def q_status_success_count(spark, sf):
    return M.status_success_count(_docs(spark, sf), "DELIVERED")


def store_report_sql(source: str) -> str:
    return (
        "SELECT t.*, (SELECT CAST(to_json(list(struct_pack(id := customerTier, count := n, revenue := rev) "
        "ORDER BY rev DESC)) AS VARCHAR) FROM (SELECT customerTier, count(*) AS n, CAST(coalesce(sum(totalAmount), 0) AS "
        f"DECIMAL(38,2)) AS rev FROM {source} GROUP BY customerTier)) AS tierDistribution FROM ("
        f"SELECT totalOrdersInDb, dlqOrders, totalOrders, totalRevenue, {O.exact_avg('totalRevenue', 'totalOrders')} "
        "AS avgOrderValue FROM (SELECT count(*) AS totalOrdersInDb, count(*) FILTER (WHERE processingStatus = 'DLQ') "
        "AS dlqOrders, count(*) FILTER (WHERE processingStatus = 'SUCCESS') AS totalOrders, CAST(coalesce(sum("
        "totalAmount) FILTER (WHERE processingStatus = 'SUCCESS'), 0) AS DECIMAL(38,2)) AS totalRevenue "
        f"FROM {source})) t")


@register("store_report", O.with_(store_report_sql("order_docs"), DOCS))
def q_store_report(spark, sf):
    r = M.store_report(_docs(spark, sf))
    return r.withColumn("tierDistribution", F.to_json("tierDistribution"))


@register("top_categories", O.with_(
    "SELECT category, CAST(coalesce(sum(totalAmount), 0) AS DECIMAL(38,2)) AS totalRevenue, count(*) AS orderCount "
    f"FROM lifecycle WHERE createdAt >= TIMESTAMP '{SINCE_CATEGORIES}' GROUP BY category "
    "ORDER BY totalRevenue DESC, category NULLS FIRST LIMIT 5", DOCS, LC))
def q_top_categories(spark, sf):
    return M.top_categories(_lc(spark, sf), _ts(SINCE_CATEGORIES), 5)


@register("hourly_stats", O.with_(
    f"SELECT {O.hour_label('createdAt')} AS hour, count(*) AS count, CAST(coalesce(sum(totalAmount), 0) AS "
    f"DECIMAL(38,2)) AS revenue FROM lifecycle WHERE createdAt >= TIMESTAMP '{HOURLY_SINCE}' GROUP BY 1 ORDER BY 1",
    DOCS, LC))
def q_hourly_stats(spark, sf):
    return M.hourly_stats(_lc(spark, sf), _ts(HOURLY_SINCE))


@register("hourly_chart", O.with_(
    f"SELECT {O.hour_label('createdAt')} AS hour, count(*) AS orders, CAST(coalesce(sum(totalAmount), 0) AS "
    f"DECIMAL(38,2)) AS revenue FROM lifecycle WHERE createdAt >= {O.AS_OF} - INTERVAL {CHART_HOURS} HOUR "
    "GROUP BY 1 ORDER BY 1", DOCS, LC))
def q_hourly_chart(spark, sf):
    return M.hourly_chart(_lc(spark, sf), CHART_HOURS, FX.as_of())


_STATUS_VALUES = ", ".join(f"('{s}')" for s in S.LIFECYCLE_STATUSES)


@register("status_counts", O.with_(
    f"SELECT s.status, count(l.status) AS orders FROM (VALUES {_STATUS_VALUES}) s(status) "
    "LEFT JOIN lifecycle l ON l.status = s.status GROUP BY s.status", DOCS, LC))
def q_status_counts(spark, sf):
    return M.status_counts(_lc(spark, sf))


DIMS = """dims AS (
SELECT coalesce(status, 'UNKNOWN') AS status, coalesce(region, 'UNKNOWN') AS region,
 coalesce(priority, 'STANDARD') AS priority, coalesce(category, 'OTHER') AS category, totalAmount,
 status AS rawStatus FROM lifecycle)"""
DIM_COUNTS = """dim_counts AS (
SELECT 'status' AS dimension, status AS value, count(*) AS orders FROM dims GROUP BY status
UNION ALL SELECT 'region', region, count(*) FROM dims GROUP BY region
UNION ALL SELECT 'priority', priority, count(*) FROM dims GROUP BY priority
UNION ALL SELECT 'category', category, count(*) FROM dims GROUP BY category)"""
_ELIG = "totalAmount IS NOT NULL AND coalesce(rawStatus, 'UNKNOWN') NOT IN ('CANCELLED', 'FAILED')"


@register("dimension_counts", O.with_("SELECT * FROM dim_counts", DOCS, LC, DIMS, DIM_COUNTS))
def q_dimension_counts(spark, sf):
    return M.dimension_counts(_lc(spark, sf))


@register("live_revenue", O.with_(
    f"SELECT totalRevenue, totalOrders, {O.money_avg('totalRevenue', 'totalOrders')} AS avgOrderValue FROM "
    f"(SELECT CAST(coalesce(sum(totalAmount) FILTER (WHERE {_ELIG}), 0) AS DECIMAL(38,2)) AS totalRevenue, "
    f"count(*) FILTER (WHERE {_ELIG}) AS totalOrders FROM dims)", DOCS, LC, DIMS))
def q_live_revenue(spark, sf):
    return M.live_revenue(_lc(spark, sf))


@register("failed_count", O.with_(
    "SELECT count(*) FILTER (WHERE status = 'FAILED') AS failedOrders FROM lifecycle", DOCS, LC))
def q_failed_count(spark, sf):
    return M.failed_count(_lc(spark, sf))


def _map_json(dim: str) -> str:
    return (f"(SELECT CAST(to_json(map_from_entries(list(struct_pack(k := value, v := orders) ORDER BY value))) "
            f"AS VARCHAR) FROM dim_counts WHERE dimension = '{dim}') AS {dim}Counts")


SNAPSHOT_BODY = (
    "SELECT " + ", ".join(_map_json(d) for d in M.DIMENSIONS) + ", totalRevenue24h, totalOrders24h, failedOrders, "
    f"{O.money_avg('totalRevenue24h', 'totalOrders24h')} AS avgOrderValue, {O.AS_OF} AS snapshotAt FROM ("
    f"SELECT CAST(coalesce(sum(totalAmount) FILTER (WHERE {_ELIG}), 0) AS DECIMAL(38,2)) AS totalRevenue24h, "
    f"count(*) FILTER (WHERE {_ELIG}) AS totalOrders24h, count(*) FILTER (WHERE rawStatus = 'FAILED') AS failedOrders "
    "FROM dims)")
SNAPSHOT_SQL = O.with_(SNAPSHOT_BODY, DOCS, LC, DIMS, DIM_COUNTS)


def _snapshot(spark, sf):
    snap = M.dashboard_snapshot(_lc(spark, sf), FX.as_of())
    return snap.select(*[F.to_json(f"{d}Counts").alias(f"{d}Counts") for d in M.DIMENSIONS],
                       "totalRevenue24h", "totalOrders24h", "failedOrders", "avgOrderValue", "snapshotAt")


@register("dashboard_snapshot", SNAPSHOT_SQL)
def q_dashboard_snapshot(spark, sf):
    return _snapshot(spark, sf)


@register("stats_feed", O.with_(
    "SELECT CAST(to_json(struct_pack(statusCounts := json(statusCounts), regionCounts := json(regionCounts), "
    "priorityCounts := json(priorityCounts), categoryCounts := json(categoryCounts), totalRevenue24h := "
    "totalRevenue24h, totalOrders24h := totalOrders24h, failedOrders := failedOrders, avgOrderValue := "
    f"avgOrderValue, snapshotAt := {O.iso('snapshotAt')})) AS VARCHAR) AS payload FROM ({SNAPSHOT_BODY}) s",
    DOCS, LC, DIMS, DIM_COUNTS))
def q_stats_feed(spark, sf):
    snap = M.dashboard_snapshot(_lc(spark, sf), FX.as_of()).withColumn("snapshotAt", X.iso_text("snapshotAt"))
    return FD.stats_json(snap)


@register("resync_24h", O.with_(
    "SELECT (SELECT CAST(to_json(map_from_entries(list(struct_pack(k := s.status, v := coalesce(c.n, 0)) "
    "ORDER BY s.pos))) AS VARCHAR)"
    f" FROM (SELECT * FROM (VALUES {', '.join(f'({i}, {chr(39)}{s}{chr(39)})' for i, s in enumerate(S.LIFECYCLE_STATUSES))})"
    " v(pos, status)) s LEFT JOIN (SELECT status, count(*) AS n FROM lifecycle GROUP BY status) c ON c.status = s.status"
    ") AS statusCounts, totalRevenue24h, totalOrders24h, failedOrders, "
    f"{O.money_avg('totalRevenue24h', 'totalOrders24h')} AS avgOrderValue, {O.AS_OF} AS snapshotAt FROM ("
    "SELECT CAST(coalesce(sum(totalAmount) FILTER (WHERE inRange AND totalAmount IS NOT NULL AND coalesce(status, '') "
    "NOT IN ('CANCELLED', 'FAILED')), 0) AS DECIMAL(38,2)) AS totalRevenue24h, count(*) FILTER (WHERE inRange) AS "
    "totalOrders24h, count(*) FILTER (WHERE status = 'FAILED') AS failedOrders FROM (SELECT *, createdAt BETWEEN "
    f"{O.AS_OF} - INTERVAL 24 HOUR AND {O.AS_OF} AS inRange FROM lifecycle))", DOCS, LC))
def q_resync_24h(spark, sf):
    r = M.resync(_lc(spark, sf), FX.as_of(), 24)
    return r.withColumn("statusCounts", F.to_json("statusCounts"))


@register("item_totals", O.with_(
    "SELECT d.orderId, coalesce(i.itemCount, 0) AS itemCount, CAST(i.itemsTotal AS DECIMAL(18,2)) AS itemsTotal "
    f"FROM {EVENTS_JOIN}", DOCS, ITEMS))
def q_item_totals(spark, sf):
    return M.item_totals(FX.order_events(spark, sf))
