"""Streaming jobs: retries drain, dead letters, replay idempotence."""
import pytest
from pyspark.sql import functions as F

from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX
from orderflow.streaming import jobs as J

from paths import SF_SMALL


def flaky(attempt):
    m = F.col("offset") % 50
    return (m < 6) & (attempt <= m)


@pytest.fixture(scope="module")
def job_run(spark):
    root = scratch_path(spark, "test-stream")
    src = J.materialize(FX.topic_log(spark, SF_SMALL), f"{root}/source", files=12, split_col="offset")
    job = J.OrderStreamJob(spark, f"{root}/job", FX.AS_OF, fails=flaky)
    last = job.run(src, f"{root}/ckpt", max_files=4)
    return job, root, src, last


def expected(spark):
    log = FX.topic_log(spark, SF_SMALL)
    m = F.col("offset") % 50
    dead = (F.col("offset") % 101 == 0) | m.isin(4, 5)
    return log.filter(~dead).count(), log.filter(dead).count()


def test_every_order_stored_once_or_dead_lettered(spark, job_run):
    job, _, _, last = job_run
    assert last == 2  # three files, one per trigger
    stored = job.store()
    n_ok, n_dead = expected(spark)
    assert stored.count() == n_ok
    assert stored.select("orderId").distinct().count() == n_ok
    dead = job.output("dead_letters")
    assert dead.count() == n_dead
    assert {r.topic for r in dead.select("topic").distinct().collect()} == {"orders.placed-dlt"}


def test_replayed_batch_is_idempotent(spark):
    """A batch that runs again (driver crash before the commit) rewrites its
    own folders with the same clock: the store is unchanged."""
    root = scratch_path(spark, "test-replay")
    log = FX.topic_log(spark, SF_SMALL)
    job = J.OrderStreamJob(spark, root, FX.AS_OF, fails=flaky)
    job.process(log, 0)
    job.drain(0)
    first = sorted(job.store().collect())
    job.process(log, 0)  # replay of batch 0
    job.drain(0)
    assert sorted(job.store().collect()) == first
    # a second delivery of the same records in a later batch: upsert keeps one row each
    job.process(log, 1)
    job.drain(1)
    again = job.store()
    assert again.count() == len(first)
    assert again.select("orderId").distinct().count() == len(first)


def test_restart_from_checkpoint_adds_nothing(spark, job_run):
    job, root, src, _ = job_run
    n_log = job.output("store_log").count()
    again = J.OrderStreamJob(spark, job.root, FX.AS_OF, fails=flaky)
    J.run_available_now(J.read_order_stream(spark, src, max_per_trigger=4),
                        lambda df, bid: again.process(df, bid), f"{root}/ckpt")
    assert job.output("store_log").count() == n_log


def test_dead_letter_consumer(spark, job_run):
    job, root, _, _ = job_run
    J.run_dead_letters(spark, job.dead_letter_folder(), f"{root}/dlt", f"{root}/dlt-ckpt")
    docs = J.read_batches(spark, f"{root}/dlt/dlq_docs")
    quarantined = J.read_batches(spark, f"{root}/dlt/quarantine")
    _, n_dead = expected(spark)
    assert docs.count() + quarantined.count() == n_dead
    assert {r.processingStatus for r in docs.collect()} == {"DLQ"}


def test_observed_flow_counters(spark, job_run):
    job = job_run[0]
    n_ok, n_dead = expected(spark)
    c = job.flow_counters().first()
    assert (c.published, c.processed, c.deadLettered, c.publishFailed) == (n_ok + n_dead, n_ok, n_dead, 0)


def test_watermark_drops_only_late_events(spark):
    """Hour windows with a 1-hour watermark.  Spark filters late input with
    the watermark of the batch before the previous one (the eviction
    watermark is newer), so after two batches an event more than an hour
    behind the newest one seen is dropped, while a slightly late one counts."""
    import datetime as dt
    root = scratch_path(spark, "test-watermark")
    from decimal import Decimal
    schema = "event_id long, ts timestamp, totalAmount decimal(18,2)"
    batches = [
        [(1, dt.datetime(2024, 1, 1, 10, 5), Decimal(1)), (2, dt.datetime(2024, 1, 1, 12, 30), Decimal(2))],
        [(5, dt.datetime(2024, 1, 1, 12, 40), Decimal(5))],
        [(3, dt.datetime(2024, 1, 1, 8, 0), Decimal(3)),     # behind the watermark (11:30): dropped
         (4, dt.datetime(2024, 1, 1, 11, 45), Decimal(4))],  # late but inside the bound: counted
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/src")
    hourly = J.hourly_stats_stream(stream, "ts", delay="1 hour")
    q = J.run_available_now(hourly, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                            output_mode="update")
    got = {r["hour"]: r["count"] for r in J.latest_per_key(J.read_batches(spark, f"{root}/out"), ["hour"]).collect()}
    assert got == {"2024-01-01T10:00:00Z": 1, "2024-01-01T11:00:00Z": 1, "2024-01-01T12:00:00Z": 2}
    assert J.late_rows(q) == 1


def test_streaming_upsert_survives_restart(spark):
    """The streaming upsert stopped and restarted from its checkpoint while
    redeliveries keep arriving ends in the same state as the batch upsert."""
    from orderflow.operators.store import upsert_orders
    root = scratch_path(spark, "test-upsert-restart")
    log = FX.deliveries(spark, SF_SMALL).select("orderId", "customerId", "status", "totalAmount", "delivery", "seq",
                                                 "ingestedAt")
    first = log.filter(F.col("delivery") == 1)
    again = log.filter(F.col("delivery") == 2)

    def run():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/src")
        J.run_available_now(J.latest_orders(stream, ["delivery", "seq"]),
                            lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt",
                            output_mode="update")

    J.materialize(first, f"{root}/src", files=4, split_col="orderId")
    run()                                                   # first deliveries, then stop
    again.repartition(2).write.mode("append").parquet(f"{root}/src")
    run()                                                   # restart: only the new files
    cols = ["orderId", "status", "totalAmount", "seq", "createdAt", "updatedAt"]
    streamed = J.latest_per_key(J.read_batches(spark, f"{root}/out"), ["orderId"]).select(cols)
    batch = upsert_orders(log, ["delivery", "seq"]).select(cols)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert streamed.filter(F.col("status") == "CANCELLED").count() == again.count()


def test_hourly_stream_takes_every_row_whatever_the_files(spark, monkeypatch):
    """Many small files in no order of time, one or more a trigger: nothing is
    late, and rows without a time stay in the source."""
    root = scratch_path(spark, "test-hourly")
    orders = FX.lifecycle_orders(FX.order_docs(spark, SF_SMALL)).select(
        F.when(F.col("kafkaOffset") % 50 != 0, F.col("createdAt")).alias("createdAt"), "totalAmount")
    monkeypatch.setattr(J, "MAX_RECORDS_PER_FILE", 100)
    src = J.materialize(orders, f"{root}/src", files=3)
    assert spark.read.parquet(src).count() == orders.count()
    delay = J.disorder(spark.read.parquet(src), "createdAt")
    for files in (1, 5):
        hourly = J.hourly_stats_stream(J.read_files(spark, src, orders.schema, files), delay=delay)
        q = J.run_available_now(hourly, lambda df, bid: J.write_batch(df, f"{root}/out{files}", bid), f"{root}/ckpt{files}", output_mode="update")
        assert J.late_rows(q) == 0
        got = J.latest_per_key(J.read_batches(spark, f"{root}/out{files}"), ["hour"]).agg(F.sum("count"), F.sum("revenue")).first()
        want = orders.filter("createdAt is not null").agg(F.count(F.lit(1)), F.sum("totalAmount")).first()
        assert tuple(got) == tuple(want)


def test_bad_payloads_end_in_quarantine_and_the_rest_in_the_store(spark, job_run):
    job, root, _, _ = job_run
    job.consume_dead_letters()
    log = FX.topic_log(spark, SF_SMALL)
    bad = log.filter(F.col("offset") % FX.MALFORMED_EVERY == 0)
    quarantined = J.read_batches(spark, f"{job.dead_letter_root()}/quarantine")
    assert {r.offset for r in quarantined.collect()} == {r.offset for r in bad.collect()}
    assert {r.rawValue for r in quarantined.collect()} >= {"", "  ", "null", "[]", "123", None}
    store = job.store()
    assert store.filter("orderId is null").count() == 0
    m = F.col("offset") % 50
    dead = log.filter(m.isin(4, 5) & (F.col("offset") % FX.MALFORMED_EVERY != 0)).count()
    assert store.filter("processingStatus = 'DLQ'").count() == dead
    # a snapshot changes nothing, nor does reading on from it
    before = sorted(store.collect())
    job.compact(1_000)
    assert sorted(job.store().select(store.columns).collect()) == before


def test_tick_must_cover_the_longest_delay(spark):
    with pytest.raises(ValueError, match="tick_seconds"):
        J.OrderStreamJob(spark, "/tmp/unused", FX.AS_OF, tick_seconds=5)
