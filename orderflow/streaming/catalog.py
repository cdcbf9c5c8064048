"""Registered streaming queries.

Each entry materialises its Spark-derived input as a file source, runs the
streaming query with ``trigger(availableNow=True)`` (a few files a
micro-batch for each task slot) and returns the sink's contents, so the
batch SQL of the same operator is its oracle.  The order job is run once for
all entries that look at its outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators import documents as D
from orderflow.operators import feed as FD
from orderflow.operators import lookup as L
from orderflow.operators import metrics as M
from orderflow.operators.buckets import BucketedStore
from orderflow.plans import catalog as C
from orderflow.plans import oracle as O
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX
from orderflow.streaming import counters as CT
from orderflow.streaming import hours as H
from orderflow.streaming import jobs as J
from orderflow.streaming import timers as TM
from orderflow.streaming.upserts import upsert_stream

QUERIES: dict = {}
ORACLE: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _scratch(spark, key):
    return scratch_path(spark, "streams", key)


def _topic_source(spark, sf, root) -> str:
    return J.materialize(FX.topic_log(spark, sf), f"{root}/source")


# ---------------------------------------------------------------------- A1
@register("order_stream_source", O.with_(
    f"SELECT key, value, topic, {O.tier_lane('key')} AS partition, \"offset\", \"timestamp\" FROM topic_log",
    O.ORDER_DOCS, O.ITEMS, C.TOPIC_LOG))
def q_order_stream_source(spark: SparkSession, sf: str) -> DataFrame:
    root = _scratch(spark, "order_stream_source")
    src = _topic_source(spark, sf, root)
    stream = J.read_order_stream(spark, src)
    J.run_available_now(stream, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt")
    return J.read_batches(spark, f"{root}/out").drop("batch_id")


# ---------------------------------------------------------------------- A8
@register("live_feed_stream", O.with_(C.LEAN_SQL + " AND d.kafkaOffset % 101 <> 0", O.ORDER_DOCS, O.ITEMS))
def q_live_feed_stream(spark, sf):
    """Lean feed rows of every record that parses, built on the stream."""
    root = _scratch(spark, "live_feed_stream")
    src = _topic_source(spark, sf, root)
    parsed = D.parse_orders(J.read_order_stream(spark, src))
    lean = FD.lean_order(D.flatten_event(parsed.filter(~F.col("parseError"))))
    J.run_available_now(lean, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt")
    return J.read_batches(spark, f"{root}/out").drop("batch_id")


# ---------------------------------------------------------------- I1 / I2
def _flaky(attempt):
    m = F.col("offset") % 50
    return (m < 6) & (attempt <= m)


_RUNS: dict[tuple[str, str], J.OrderStreamJob] = {}


def run_order_job(spark, sf) -> J.OrderStreamJob:
    """The order job over the whole topic, its dead letters consumed; run once
    a Spark application and input, since several entries read its outputs."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        root = _scratch(spark, "order_job")
        src = _topic_source(spark, sf, root)
        job = J.OrderStreamJob(spark, f"{root}/job", FX.AS_OF, fails=_flaky)
        job.run(src, f"{root}/ckpt")
        job.consume_dead_letters()
        _RUNS[key] = job
    return _RUNS[key]


def forget_runs() -> None:
    """The next entry that looks at the order job runs it anew."""
    _RUNS.clear()


@register("process_orders_stream", O.with_(
    "SELECT d.orderId, CASE WHEN a.attempt = 1 THEN a.topic ELSE a.topic || '-retry-' || CAST(a.attempt - 2 AS "
    "VARCHAR) END AS kafkaTopic, a.\"offset\" AS kafkaOffset, 'SUCCESS' AS processingStatus, a.attempt "
    "FROM attempts a JOIN order_docs d ON d.kafkaOffset = a.\"offset\" WHERE a.ok",
    O.ORDER_DOCS, O.ITEMS, C.TOPIC_LOG, C.ATTEMPTS))
def q_process_orders_stream(spark, sf):
    """Stored orders after the stream and its retry drain: each order once,
    with the topic (main or retry-k) of the attempt that succeeded."""
    return _attempts_stored(run_order_job(spark, sf))


def _attempts_stored(job: J.OrderStreamJob) -> DataFrame:
    retry_no = F.regexp_extract("kafkaTopic", r"-retry-(\d+)$", 1)
    stored = job.store(["orderId", "kafkaTopic", "kafkaOffset", "processingStatus"])
    return stored.filter(F.col("processingStatus") == "SUCCESS").select(
        "orderId", "kafkaTopic", "kafkaOffset", "processingStatus",
        F.when(retry_no == "", F.lit(1)).otherwise(retry_no.cast("int") + 2).cast("int").alias("attempt"))


@register("retry_timers_stream", ORACLE["process_orders_stream"])
def q_retry_timers_stream(spark, sf):
    """I1 and I2 by timers: every pending retry is a row of keyed state until it is due."""
    root = _scratch(spark, "retry_timers")
    job = TM.TimedOrderJob(spark, f"{root}/job", FX.AS_OF, fails=_flaky)
    job.run(_topic_source(spark, sf, root), f"{root}/ckpt")
    return _attempts_stored(job)


@register("feed_once_stream", O.with_(C.LEAN_SQL + " AND d.kafkaOffset % 101 <> 0", O.ORDER_DOCS, O.ITEMS))
def q_feed_once_stream(spark, sf):
    """A8 on a source that delivers each record twice: the feed has it once."""
    root = _scratch(spark, "feed_once")
    src = _topic_source(spark, sf, root)
    spark.read.parquet(src).write.mode("append").parquet(src)
    feed = J.feed_once(J.read_order_stream(spark, src))
    J.run_available_now(feed, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt")
    return J.read_batches(spark, f"{root}/out").drop("batch_id")


# ---------------------------------------------------------------------- I4
@register("dead_letter_stream", C.ORACLE["dead_letter_sink"])
def q_dead_letter_stream(spark, sf):
    """The dead-letter consumer's own output."""
    docs = J.read_batches(spark, f"{run_order_job(spark, sf).dead_letter_root()}/dlq_docs")
    return docs.select("orderId", "retryCount", "lastError", "processingStatus", "kafkaTopic", "kafkaPartition",
                       "kafkaOffset")


@register("stored_dlq_orders", C.ORACLE["dead_letter_sink"])
def q_stored_dlq_orders(spark, sf):
    """B22 on the job's own store: dead letters are stored beside the orders."""
    columns = ["orderId", "retryCount", "lastError", "processingStatus", "kafkaTopic", "kafkaPartition", "kafkaOffset"]
    return L.by_processing_status(run_order_job(spark, sf).store(columns), "DLQ")


STORED = """stored AS (
SELECT d.customerTier, d.totalAmount, 'SUCCESS' AS processingStatus FROM attempts a JOIN order_docs d ON d.kafkaOffset = a."offset" WHERE a.ok
UNION ALL SELECT customerTier, totalAmount, 'DLQ' FROM order_docs WHERE kafkaOffset % 50 IN (4, 5) AND kafkaOffset % 101 <> 0)"""


@register("stored_report", O.with_(C.store_report_sql("stored"), O.ORDER_DOCS, O.ITEMS, C.TOPIC_LOG, C.ATTEMPTS, STORED))
def q_stored_report(spark, sf):
    """D14 on the job's own store."""
    r = M.store_report(run_order_job(spark, sf).store(["customerTier", "totalAmount", "processingStatus"]))
    return r.withColumn("tierDistribution", F.to_json("tierDistribution"))


# ---------------------------------------------------------------------- I5
def _lifecycle_source(spark, sf, root) -> str:
    return J.materialize(FX.lifecycle_orders(FX.order_docs(spark, sf)), f"{root}/source")


def _lifecycle_schema(spark, sf):
    return FX.lifecycle_orders(FX.order_docs(spark, sf)).schema


@register("live_counters_stream", C.ORACLE["dimension_counts"])
def q_live_counters_stream(spark, sf):
    """D8 counters kept by a stateful streaming aggregation (update mode);
    the sink log is folded to the latest count per (dimension, value)."""
    root = _scratch(spark, "live_counters_stream")
    src = _lifecycle_source(spark, sf, root)
    stream = J.read_files(spark, src, _lifecycle_schema(spark, sf))
    counters = J.live_counters(stream)
    J.run_available_now(counters, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                        output_mode="update")
    out = J.read_batches(spark, f"{root}/out")
    return J.latest_per_key(out, ["dimension", "value"]).select("dimension", "value", "orders")


@register("counters_state_stream", C.ORACLE["dimension_counts"])
def q_counters_state_stream(spark, sf):
    """The counters read from the state store itself, a row a counter, without a log of updates."""
    root = _scratch(spark, "counters_state")
    counters = CT.LiveCounters(spark, f"{root}/counters")
    counters.run(J.read_files(spark, _lifecycle_source(spark, sf, root), _lifecycle_schema(spark, sf)))
    return counters.read()


# ---------------------------------------------------------------------- I6
DRIFT_SQL = """drift AS (SELECT dimension, value, count(*) AS n FROM (
SELECT unnest(['status', 'region', 'priority', 'category']) AS dimension, unnest([coalesce(status, 'UNKNOWN'), coalesce(region, 'UNKNOWN'),
 coalesce(priority, 'STANDARD'), coalesce(category, 'OTHER')]) AS value FROM lifecycle WHERE kafkaOffset % 97 = 0) GROUP BY 1, 2)"""


@register("counters_repaired_stream", O.with_(
    "SELECT c.dimension, c.value, c.orders, coalesce(d.n, 0) AS diff FROM dim_counts c LEFT JOIN drift d ON d.dimension = c.dimension "
    "AND d.value = c.value", O.ORDER_DOCS, O.LIFECYCLE, C.DIMS, C.DIM_COUNTS, DRIFT_SQL))
def q_counters_repaired_stream(spark, sf):
    """Some orders are counted twice; the audit finds by how much each counter is off, the repair sets them right in the state."""
    root = _scratch(spark, "counters_repaired")
    orders = FX.lifecycle_orders(FX.order_docs(spark, sf))
    stream = J.read_files(spark, J.materialize(orders, f"{root}/source"), orders.schema)
    counters = CT.LiveCounters(spark, f"{root}/counters")
    counters.correct(CT.counter_rows(orders.filter("kafkaOffset % 97 = 0")))
    counters.run(stream)
    found = counters.repair(M.dimension_counts(orders))
    counters.run(stream)
    return counters.read().join(found.select("dimension", "value", "diff"), ["dimension", "value"])


@register("resync_job", O.with_(
    "SELECT dimension, value, orders AS live, orders AS store, CAST(0 AS BIGINT) AS diff FROM dim_counts "
    "WHERE dimension = 'status'", O.ORDER_DOCS, O.LIFECYCLE, C.DIMS, C.DIM_COUNTS))
def q_resync_job(spark, sf):
    """The 5-minute resync as an audit: live status counters (from the
    stream's state) against a recount from the store."""
    live = q_live_counters_stream(spark, sf).filter(F.col("dimension") == "status")
    store = M.status_counts(FX.lifecycle_orders(FX.order_docs(spark, sf)))
    j = live.join(store.withColumnRenamed("orders", "store"), live.value == store.status, "full")
    return j.select(
        F.coalesce(F.col("dimension"), F.lit("status")).alias("dimension"),
        F.coalesce(F.col("value"), F.col("status")).alias("value"),
        F.coalesce(F.col("orders"), F.lit(0)).alias("live"),
        F.coalesce(F.col("store"), F.lit(0)).alias("store"),
        (F.coalesce(F.col("orders"), F.lit(0)) - F.coalesce(F.col("store"), F.lit(0))).alias("diff"),
    ).filter((F.col("live") > 0) | (F.col("store") > 0))


# ---------------------------------------------------------------------- I7
@register("latest_order_stream", O.with_(
    "SELECT orderId, customerId, status, totalAmount, delivery, seq, createdAt, updatedAt FROM (SELECT *, row_number() OVER "
    "(PARTITION BY orderId ORDER BY delivery DESC, seq DESC) AS rn, min(ingestedAt) OVER (PARTITION BY orderId) AS createdAt, "
    "ingestedAt AS updatedAt FROM deliveries) WHERE rn = 1", O.ORDER_DOCS, C.DELIVERIES))
def q_latest_order_stream(spark, sf):
    root = _scratch(spark, "latest_order_stream")
    log = FX.deliveries(spark, sf).select("orderId", "customerId", "status", "totalAmount", "delivery", "seq", "ingestedAt")
    src = J.materialize(log, f"{root}/source")
    latest = J.latest_orders(J.read_files(spark, src, log.schema), ["delivery", "seq"])
    J.run_available_now(latest, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                        output_mode="update")
    return J.latest_per_key(J.read_batches(spark, f"{root}/out"), ["orderId"]).select(
        "orderId", "customerId", "status", "totalAmount", "delivery", "seq", "createdAt", "updatedAt")


# ---------------------------------------------------------------------- I8
@register("hourly_stats_stream", O.with_(
    f"SELECT {O.hour_label('createdAt')} AS hour, count(*) AS count, CAST(coalesce(sum(totalAmount), 0) AS "
    "DECIMAL(38,2)) AS revenue FROM lifecycle WHERE createdAt IS NOT NULL GROUP BY 1", O.ORDER_DOCS, O.LIFECYCLE))
def q_hourly_stats_stream(spark, sf):
    """D5 on a stream, over all hours.  Files arrive in no order of time, so
    the watermark waits for the measured span of the source: no row is late
    however many files a micro-batch takes, and the state is one row an hour."""
    root = _scratch(spark, "hourly_stats_stream")
    orders = FX.lifecycle_orders(FX.order_docs(spark, sf)).select("createdAt", "totalAmount")
    src = J.materialize(orders, f"{root}/source")
    hourly = J.hourly_stats_stream(J.read_files(spark, src, orders.schema), delay=J.disorder(spark.read.parquet(src), "createdAt"))
    q = J.run_available_now(hourly, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                            output_mode="update")
    if late := J.late_rows(q):
        raise RuntimeError(f"{late} rows came later than the measured bound")
    return J.latest_per_key(J.read_batches(spark, f"{root}/out"), ["hour"]).select("hour", "count", "revenue")


@register("hourly_late_stream", ORACLE["hourly_stats_stream"])
def q_hourly_late_stream(spark, sf):
    """D5 on a stream with a lateness bound of one hour, files in no order of time: closed hours, late deltas and the open
    hours of the state add up to the whole."""
    root = _scratch(spark, "hourly_late")
    orders = FX.lifecycle_orders(FX.order_docs(spark, sf)).select("createdAt", "totalAmount", "kafkaOffset")
    src = J.materialize(orders, f"{root}/source", files=6, split_col="kafkaOffset")
    hours = H.HourlyTotals(spark, f"{root}/hours")
    hours.run(J.read_files(spark, src, orders.schema, 2))
    return hours.corrected()


@register("upsert_buckets_stream", O.with_(
    "SELECT orderId, customerId, status, totalAmount, delivery, seq, createdAt, updatedAt FROM (SELECT *, row_number() OVER "
    "(PARTITION BY orderId ORDER BY delivery DESC, seq DESC) AS rn, min(ingestedAt) OVER (PARTITION BY orderId) AS createdAt, "
    "ingestedAt AS updatedAt FROM deliveries) WHERE rn = 1", O.ORDER_DOCS, C.DELIVERIES))
def q_upsert_buckets_stream(spark, sf):
    """I7 without streaming state: micro-batches, late redeliveries among them, merged into the bucketed store."""
    root = _scratch(spark, "upsert_buckets")
    log = FX.deliveries(spark, sf).select("orderId", "customerId", "status", "totalAmount", "delivery", "seq", "ingestedAt")
    J.materialize(log.filter("delivery = 2"), f"{root}/source")
    log.filter("delivery = 1").write.mode("append").parquet(f"{root}/source")
    store = BucketedStore(spark, f"{root}/store", ["delivery", "seq"], buckets=16)
    upsert_stream(J.read_files(spark, f"{root}/source", log.schema), store, f"{root}/ckpt")
    return store.read().select("orderId", "customerId", "status", "totalAmount", "delivery", "seq", "createdAt", "updatedAt")


# ---------------------------------------------------------------------- I9
def _feed_stream(spark, sf, root):
    feed = FD.lean_order(FX.order_events(spark, sf), keep=["kafkaOffset"])
    return J.read_files(spark, J.materialize(feed, f"{root}/source"), feed.schema)


def _last_batch(spark, out_root):
    out = J.read_batches(spark, out_root)
    last = out.agg(F.max("batch_id")).scalar()
    return out.filter(F.col("batch_id") == last).drop("batch_id")


def _counts_then(spark, sf, key, counts_of, finish):
    """Dashboard maths on the live feed: a complete-mode count table on the
    stream (a handful of rows), finished per micro-batch by ``finish``."""
    root = _scratch(spark, key)
    counts = counts_of(_feed_stream(spark, sf, root))
    J.run_available_now(counts, lambda df, bid: J.write_batch(finish(df), f"{root}/out", bid), f"{root}/ckpt",
                        output_mode="complete")
    return _last_batch(spark, f"{root}/out")


@register("premium_split_stream", C.ORACLE["premium_split"])
def q_premium_split_stream(spark, sf):
    """D16 on the live feed."""
    return _counts_then(spark, sf, "premium_split_stream", M.premium_counts, M.premium_split_from_counts)


@register("region_share_stream", C.ORACLE["region_share"])
def q_region_share_stream(spark, sf):
    """D17 on the live feed."""
    return _counts_then(spark, sf, "region_share_stream", lambda f: M.share_counts(f, "region"),
                        lambda c: M.share_from_counts(c, "region"))


@register("payment_share_stream", C.ORACLE["payment_share"])
def q_payment_share_stream(spark, sf):
    """D18 on the live feed."""
    return _counts_then(spark, sf, "payment_share_stream", lambda f: M.share_counts(f, "paymentMethod"),
                        lambda c: M.share_from_counts(c, "paymentMethod"))


@register("session_totals_stream", C.ORACLE["session_totals"])
def q_session_totals_stream(spark, sf):
    """D15 on the live feed."""
    root = _scratch(spark, "session_totals_stream")
    totals = M.session_totals(_feed_stream(spark, sf, root))
    J.run_available_now(totals, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                        output_mode="complete")
    out = J.read_batches(spark, f"{root}/out")
    last = out.agg(F.max("batch_id")).scalar()
    return out.filter(F.col("batch_id") == last).drop("batch_id")


# --------------------------------------------------------------------- D19
@register("flow_counters_stream", C.ORACLE["flow_counters"])
def q_flow_counters_stream(spark, sf):
    """D19 live: the order job's counters, observed on each micro-batch with
    ``DataFrame.observe`` (published, processed, dead-lettered)."""
    return run_order_job(spark, sf).flow_counters()


# --------------------------------------------------------------------- A10
@register("stats_feed_stream", C.ORACLE["stats_feed"])
def q_stats_feed_stream(spark, sf):
    """A10: the dashboard snapshot published on every micro-batch from the
    stream's counters (complete mode over the small counter table); the last
    payload is the current one."""
    root = _scratch(spark, "stats_feed_stream")
    src = _lifecycle_source(spark, sf, root)
    stream = J.read_files(spark, src, _lifecycle_schema(spark, sf))
    counters = M.counter_sets(stream)
    J.run_available_now(counters, J.stats_feed_process(f"{root}/out", FX.AS_OF), f"{root}/ckpt",
                        output_mode="complete")
    out = J.read_batches(spark, f"{root}/out")
    last = out.agg(F.max("batch_id")).scalar()
    return out.filter(F.col("batch_id") == last).drop("batch_id")
