"""Streams on more records: timers shared by records, pruned store reads, narrow shuffles, fewer micro-batches."""
import contextlib
import datetime as dt
import inspect
import io
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX
from orderflow.streaming import jobs as J
from orderflow.streaming import timers as TM


def records(spark, offsets):
    value = '{{"orderId":"ORD-{0}","customerId":"C","customerTier":"BASIC","status":"PLACED","totalAmount":1.5,"currency":"INR","region":"EAST"}}'
    rows = [("BASIC:C", value.format(o) if o % 7 else "{", S.ORDER_TOPIC, 1, o, dt.datetime(2024, 1, 1)) for o in offsets]
    return spark.createDataFrame(rows, S.ENVELOPE)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_timers_end_when_a_record_comes_twice(spark):
    root = scratch_path(spark, "test-twice-timed")
    src = J.materialize(records(spark, [*range(1, 7)] * 2), f"{root}/src", files=1)
    job = TM.TimedOrderJob(spark, f"{root}/job", FX.AS_OF, fails=lambda attempt: attempt < 3)
    began = time.monotonic()
    job.run(src, f"{root}/ckpt", timeout=120)
    assert time.monotonic() - began < 110  # it does not wait for the records that replaced themselves
    assert sorted((r.orderId, r.kafkaTopic) for r in job.store().collect()) == [(f"ORD-{o}", f"{S.ORDER_TOPIC}-retry-1") for o in range(1, 7)]


def test_retries_left_over_are_no_result(spark):
    """time that runs out is an error, and the next run takes what was left."""
    root = scratch_path(spark, "test-late")
    src = J.materialize(records(spark, range(1, 7)), f"{root}/src", files=1)
    job = TM.TimedOrderJob(spark, f"{root}/job", FX.AS_OF, fails=lambda attempt: attempt < 3)
    with pytest.raises(TimeoutError, match="6 retries"):
        job.run(src, f"{root}/ckpt", timeout=0)
    job.run(src, f"{root}/ckpt")
    assert job.store().count() == 6 and job.pending() == 0


def test_no_run_has_a_time_limit_of_its_own():
    """a limit is the caller's."""
    for run in (TM.TimedOrderJob.run, TM.TimedOrderJob.run_retries):
        assert inspect.signature(run).parameters["timeout"].default is None


def test_a_batch_planned_before_the_records_is_not_the_end(spark):
    """F1: a restart begins with the micro-batch that was cut off, which knows nothing of later records."""
    job = TM.TimedOrderJob(spark, scratch_path(spark, "test-cut-off"), FX.AS_OF, fails=lambda attempt: attempt < 3)
    checkpoint, cut_off = f"{job.root}/ckpt_retries", []
    job.process(records(spark, range(1, 7)), 0)
    job.run_retries(checkpoint, timeout=120)
    job.process = lambda *a: cut_off.append(a) or 1 / 0
    q = job.start_retries(checkpoint)  # nothing new in the topic
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    assert cut_off
    del job.process
    job.process(records(spark, range(15, 21)), 1)
    job.run_retries(checkpoint, timeout=120)
    assert job.store().count() == 12 and job.pending() == 0


def test_a_state_whose_rows_are_not_counted_is_not_empty(spark):
    """without ``trackTotalNumberOfRows`` the state always reports no rows."""
    job = TM.TimedOrderJob(spark, scratch_path(spark, "test-uncounted"), FX.AS_OF, fails=lambda attempt: attempt < 2)
    job.process(records(spark, range(1, 7)), 0)
    due = job.output("retries").agg(F.max("dueAt")).first()[0].astimezone(dt.timezone.utc)
    job._taken = {3: 0}
    files = {"description": "FileStreamSource[x]", "numInputRows": 0, "startOffset": "{'logOffset': 0}", "endOffset": "{'logOffset': 0}"}

    def idle(seconds, source=files, rows=0):
        return job._idle({"batchId": 3, "timestamp": (due + dt.timedelta(seconds=seconds)).isoformat(timespec="milliseconds").replace("+00:00", "Z"),
                          "sources": [source], "stateOperators": [{"numRowsTotal": rows}]})

    assert idle(1) and not idle(0) and not idle(-1) and not idle(1, rows=1)
    assert not idle(1, {**files, "endOffset": "{'logOffset': 1}"})  # a file without rows: others may follow


def test_small_files_of_the_retry_topic_are_one_batch(spark):
    root = scratch_path(spark, "test-small-files")
    job = TM.TimedOrderJob(spark, root, FX.AS_OF)
    rec = F.struct(*S.ENVELOPE.fieldNames(), F.lit(2).alias("attempt"), F.col("timestamp").alias("dueAt"))
    n = 2 * spark.sparkContext.defaultParallelism
    records(spark, range(n)).repartition(n).select(rec.alias("rec")).write.parquet(job._kind_path("retries"))
    seen = []
    J.run_available_now(job.retry_topic(), lambda df, bid: seen.append(df.count()), f"{root}/ckpt")
    assert seen == [n]


def test_the_session_keeps_its_shuffle_partitions(spark):
    job = TM.TimedOrderJob(spark, scratch_path(spark, "test-stores"), FX.AS_OF, fails=lambda attempt: attempt < 2)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    many = 2 * TM.STORES_PER_SLOT * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(many))
    try:
        job.process(records(spark, range(1, 7)), 0)
        q = job.start_retries(f"{job.root}/ckpt_retries")
        until = time.monotonic() + 120
        while job.pending() and time.monotonic() < until:
            time.sleep(0.2)
        stores = {s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]}
        q.stop()
        assert stores == {many // 2} and job.pending() == 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(many)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_the_store_reads_what_is_asked_for(spark):
    job = J.OrderStreamJob(spark, scratch_path(spark, "test-pruned"), FX.AS_OF, fails=lambda attempt: (F.col("offset") == 3) & (attempt < 5))
    job.process(records(spark, range(1, 20)), 0)
    job.process(records(spark, range(1, 9)), 1)  # delivered again: the later arrival counts
    job.drain(1)
    job.consume_dead_letters()
    cols = ["orderId", "kafkaTopic", "processingStatus", "totalAmount"]

    def same(made):
        assert sorted(made.collect(), key=str) == sorted(job.store().select(made.columns).collect(), key=str)

    narrow = job.store(cols)
    assert "items" not in plan(narrow) and "paymentMethod" not in plan(narrow) and "WindowGroupLimit" in plan(narrow)
    same(narrow)
    same(job.store([*cols, "id", "createdAt"]))
    same(job.store([*cols, "updatedAt"]))
    job.compact(1)
    job.process(records(spark, range(15, 30)), 2)
    same(job.store(cols))
    assert job.store(cols).count() == 29 - 4  # but for the malformed


def test_feed_once_shuffles_no_record_text(spark):
    root = scratch_path(spark, "test-feed-once")
    rows = records(spark, range(1, 30))
    src = J.materialize(rows, f"{root}/src", files=3)
    rows.write.mode("append").parquet(src)
    feed = J.feed_once(J.read_order_stream(spark, src))
    before = feed._jdf.queryExecution().analyzed().toString().splitlines()
    at = next(i for i, line in enumerate(before) if "DeduplicateWithinWatermark" in line)
    assert not any("value#" in line for line in before[at:at + 4]), before
    J.run_available_now(feed, lambda df, bid: J.write_batch(df, f"{root}/out", bid), f"{root}/ckpt")
    out = J.read_batches(spark, f"{root}/out").drop("batch_id")
    assert sorted(r.orderId for r in out.collect()) == sorted(f"ORD-{o}" for o in range(1, 30) if o % 7)


def test_micro_batches_take_several_files_a_slot(spark):
    root = scratch_path(spark, "test-files")
    n = 2 * spark.sparkContext.defaultParallelism
    src = J.materialize(records(spark, range(n)), f"{root}/src", files=n)
    seen = []
    J.run_available_now(J.read_order_stream(spark, src), lambda df, bid: seen.append(df.count()), f"{root}/ckpt")
    assert seen == [n]
