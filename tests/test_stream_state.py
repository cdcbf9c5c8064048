"""Timers, counters in the state, lateness, repeated records, clearing."""
import datetime as dt
import os
import subprocess
import sys
import time
from decimal import Decimal

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from orderflow.operators import metrics as M
from orderflow.session import list_folders, prepare_processors, scratch_path
from orderflow.sources import fixtures as FX
from orderflow.streaming import counters as CT
from orderflow.streaming import hours as H
from orderflow.streaming import jobs as J
from orderflow.streaming import timers as TM

from paths import SF_SMALL


def flaky(attempt):
    m = F.col("offset") % 50
    return (m < 6) & (attempt <= m)


@pytest.fixture(scope="module")
def log(spark):
    path = scratch_path(spark, "test-topic")
    return spark.read.parquet(J.materialize(FX.topic_log(spark, SF_SMALL).where("offset < 900"), path, files=4, split_col="offset")), path


def stored(job):
    return sorted(job.store().select("orderId", "kafkaTopic", "kafkaOffset", "processingStatus").collect())


@pytest.fixture(scope="module")
def ticked(spark, log):
    """The job with drain ticks, for comparison."""
    job = J.OrderStreamJob(spark, scratch_path(spark, "test-ticked"), FX.AS_OF, fails=flaky)
    job.run(log[1], f"{job.root}/ckpt")
    job.consume_dead_letters()
    return job


def test_timers_equal_ticks(spark, log, ticked, monkeypatch):
    listed = []
    monkeypatch.setattr(J, "list_folders", lambda *a: listed.append(a) or [])
    job = TM.TimedOrderJob(spark, scratch_path(spark, "test-timers"), FX.AS_OF, fails=flaky)
    job.run(log[1], f"{job.root}/ckpt", max_files=2)
    assert not listed and job.pending() == 0
    job.consume_dead_letters()
    assert stored(job) == stored(ticked)
    assert job.flow_counters().collect() == ticked.flow_counters().collect()
    n = job.output("store_log").count()
    job.run(log[1], f"{job.root}/ckpt")  # again, from the checkpoints
    assert job.output("store_log").count() == n


def test_timers_wait_and_survive_a_restart(spark, log, ticked):
    """On the wall clock no retry is taken before it is due, and pending ones outlive the query."""
    job = TM.TimedOrderJob(spark, scratch_path(spark, "test-restart"), FX.AS_OF, fails=flaky, clock="wall")
    first = J.run_available_now(J.read_order_stream(spark, log[1]), lambda df, bid: job.process(df, bid), f"{job.root}/ckpt")
    assert J.last_batch_id(first) >= 0 and job.pending() > 0
    q = job.start_retries(f"{job.root}/ckpt_retries")
    until = time.monotonic() + 120
    while not any(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) and time.monotonic() < until:
        time.sleep(0.2)
    q.stop()
    assert job.pending() > 0
    again = TM.TimedOrderJob(spark, job.root, FX.AS_OF, fails=flaky, clock="wall")  # a new driver
    again.run_retries(f"{job.root}/ckpt_retries", timeout=150)
    assert again.pending() == 0
    again.consume_dead_letters()
    assert stored(again) == stored(ticked)
    # each attempt's time is after the time it was due
    due = again.output("retries").select("offset", F.col("attempt"), "dueAt")
    taken = again.output("store_log").where("kafkaTopic like '%retry%'").select(
        F.col("kafkaOffset").alias("offset"), (F.regexp_extract("kafkaTopic", r"(\d+)$", 1).cast("int") + 2).alias("attempt"), "ingestedAt")
    both = due.join(taken, ["offset", "attempt"])
    assert both.count() == taken.count() > 0 and both.where("ingestedAt < dueAt").count() == 0


@pytest.mark.parametrize(("module", "name"), [(TM, "HoldUntilDue"), (H, "OpenHours")])
def test_processors_run_where_the_package_is_not(spark, tmp_path, module, name):
    prepare_processors(spark, module.__name__)
    sent = cloudpickle.dumps(getattr(module, name)())
    code = "import pickle, sys; p = pickle.loads(sys.stdin.buffer.read()); print(type(p).__name__, 'orderflow' in sys.modules)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=sent, capture_output=True, cwd=tmp_path, env=env, check=False)
    assert done.stdout.decode().split() == [name, "False"], done.stderr.decode()


def test_what_a_topic_would_not_take(spark):
    rows = [("k", "{}", "orders.placed", 1, 1, dt.datetime(2024, 1, 1)), (None, "{}", "orders.placed", 1, 2, dt.datetime(2024, 1, 1)),
            ("k", "{" + "x" * 100, "orders.placed", 1, 3, dt.datetime(2024, 1, 1)), ("k", "{}", "orders.placed", None, 4, None)]
    batch = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    job = J.OrderStreamJob(spark, scratch_path(spark, "test-rejected"), FX.AS_OF, max_bytes=50)
    job.process(batch, 0)
    job.drain(0)
    assert tuple(job.flow_counters().first()) == (1, 3, 1, 0)
    assert {r.offset for r in job.output("rejected").collect()} == {2, 3, 4}
    assert job.output("retries") is None


def test_records_delivered_twice_count_once(spark, log, ticked):
    rows, path = log
    twice = scratch_path(spark, "test-twice")
    J.materialize(rows.unionByName(rows), twice, files=3)
    rows.limit(300).coalesce(1).write.mode("append").parquet(twice)
    job = J.OrderStreamJob(spark, scratch_path(spark, "test-once"), FX.AS_OF, fails=flaky, once_within="1 hour")
    job.run(twice, f"{job.root}/ckpt", max_files=2)
    job.consume_dead_letters()
    assert job.flow_counters().collect() == ticked.flow_counters().collect()
    feed = ["orderId", "status", "totalAmount", "offset", "topic"]
    assert sorted(job.output("feed").select(feed).collect(), key=str) == sorted(ticked.output("feed").select(feed).collect(), key=str)
    assert stored(job) == stored(ticked)


@pytest.fixture(scope="module")
def orders(spark):
    path = scratch_path(spark, "test-orders")
    df = FX.lifecycle_orders(FX.order_docs(spark, SF_SMALL)).withColumn("region", F.when(F.col("kafkaOffset") % 31 != 0, F.col("region")))
    J.materialize(df, path, files=6, split_col="kafkaOffset")
    return spark.read.parquet(path), path


def counts(df):
    return {(r.dimension, r.value): r.orders for r in df.collect()}


def test_counters_are_read_audited_and_repaired_in_the_state(spark, orders):
    rows, path = orders
    want = counts(M.dimension_counts(rows))
    c = CT.LiveCounters(spark, scratch_path(spark, "test-counters"))
    stream = J.read_files(spark, path, rows.schema, 3)
    c.run(stream)
    assert counts(c.read()) == want
    assert not any("/corrections" in f or path in f for f in c.read().inputFiles())  # the state alone
    assert c.audit(M.dimension_counts(rows)).where("diff <> 0").count() == 0
    drift = {("status", "PLACED"): 7, ("region", "NOWHERE"): 5, ("priority", "EXPRESS"): -3}
    c.correct(spark.createDataFrame([(*k, n) for k, n in drift.items()], CT.ROWS))
    c.run(stream)
    found = c.repair(M.dimension_counts(rows)).where("diff <> 0")
    assert {(r.dimension, r.value): r["diff"] for r in found.collect()} == drift
    assert counts(c.read()) != want
    c.run(stream)
    assert counts(c.read()) == want
    c.run(stream)  # a correction is taken once
    assert counts(c.read()) == want and c.repair(M.dimension_counts(rows)).where("diff <> 0").count() == 0


def test_counters_restart_from_a_recount(spark, orders):
    rows, _ = orders
    before, after = (rows.where(F.col("kafkaOffset") % 3 == 0), rows.where(F.col("kafkaOffset") % 3 > 0))
    root = scratch_path(spark, "test-reseed")
    c = CT.LiveCounters(spark, f"{root}/counters")
    c.run(J.read_files(spark, J.materialize(rows.limit(10), f"{root}/a", files=1), rows.schema))  # counted something else
    c.restart(M.dimension_counts(before))
    c.run(J.read_files(spark, J.materialize(after, f"{root}/b", files=2), rows.schema))
    assert counts(c.read()) == counts(M.dimension_counts(rows)) and c.generation().endswith("gen=1")


def test_late_rows_correct_closed_hours(spark):
    """Whatever the order of the files, the sum is the batch result, and the state holds open hours only."""
    root = scratch_path(spark, "test-late")
    schema = "createdAt timestamp, totalAmount decimal(18,2)"
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[(t(10, 5), Decimal("1.10")), (t(12, 30), Decimal("2"))], [(t(12, 40), Decimal("-5.05")), (None, Decimal("9"))],
               [(t(8), Decimal("99999999999999.99")), (t(8, 30), None), (t(11, 45), Decimal("4")), (t(10, 59), Decimal("1"))],
               [(t(15), Decimal("1"))], [(t(8, 59), Decimal("0.01")), (t(14, 10), Decimal("3"))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/src")
        time.sleep(0.02)  # files are taken in order of their time
    hours = H.HourlyTotals(spark, root)
    q = hours.run(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/src"), "createdAt")
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    want = everything.where("createdAt is not null").groupBy(F.date_format(F.date_trunc("hour", "createdAt"), "yyyy-MM-dd'T'HH:00:00'Z'").alias("hour")).agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("totalAmount"), F.lit(0)).cast("decimal(38,2)").alias("revenue"))
    assert sorted(hours.corrected().collect()) == sorted(want.collect())
    assert hours.written("late").count() >= 1 and hours.written("closed").count() >= 3
    open_now = {dt.datetime.fromtimestamp(r.hourStart / 1000, dt.timezone.utc).hour for r in hours.open_hours().collect()}
    assert open_now == {14, 15}  # the newest event less an hour is 14:00
    assert J.late_rows(q) == 0  # none is dropped by Spark


def test_shuffled_files_under_a_bound_of_one_hour(spark, orders):
    rows, path = orders
    hours = H.HourlyTotals(spark, scratch_path(spark, "test-shuffled"))
    q = hours.run(J.read_files(spark, path, rows.schema, 1))
    got = hours.corrected()
    want = M.hourly_stats(rows, F.lit("1900-01-01").cast("timestamp")).select("hour", "count", "revenue")
    assert sorted(got.collect()) == sorted(want.collect())
    assert hours.open_hours().count() <= 2 < hours.written("late").count()
    assert max(s["numRowsTotal"] for p in q.recentProgress[-1:] for s in p["stateOperators"]) <= 8


def test_clearing_keeps_folders_level(spark):
    """Batches with a snapshot and a clearing now and then: as many folders at the end as early on, the same store."""
    log = FX.topic_log(spark, SF_SMALL).where("offset < 300").coalesce(2).cache()
    keep = J.OrderStreamJob(spark, scratch_path(spark, "test-kept"), FX.AS_OF, fails=flaky)
    job = J.OrderStreamJob(spark, scratch_path(spark, "test-cleared"), FX.AS_OF, fails=flaky)

    def folders():
        return sum(len(list_folders(spark, f"{job.paths['out']}/{k}/{m}")) for k in list_folders(spark, job.paths["out"])
                   for m in list_folders(spark, f"{job.paths['out']}/{k}")) + sum(len(list_folders(spark, job.paths[n])) for n in ("ticks", "flow"))

    sizes, n, before = [], 4, -1
    for b in range(n):
        part = log.where(F.col("offset") % n == b)
        for j in (job, keep):
            j.process(part, b)
        if b % 2:
            assert job.horizon() == before and job.clear() >= 0  # nothing goes that a later batch needs
            for j in (job, keep):
                j.drain(b)
            job.consume_dead_letters()
            job.compact(b)
            assert job.clear() > 0 and job.horizon() == b
            before = b
            sizes.append(folders())
    assert max(sizes[1:]) <= sizes[0] + 1, sizes
    keep.consume_dead_letters()
    cols = ["orderId", "status", "kafkaTopic", "kafkaOffset", "processingStatus"]
    stored_now = sorted(job.store().select(cols).collect())
    assert stored_now == sorted(keep.store().select(cols).collect())
    assert job.flow_counters().collect() == keep.flow_counters().collect()
    job.process(log.where(F.col("offset") % n == n - 1), n - 1)  # the last batch runs again
    job.drain(n - 1)
    assert sorted(job.store().select(cols).collect()) == stored_now
