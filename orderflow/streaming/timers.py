"""Delayed retries by timers (I1, I2): keyed state instead of drain ticks.

The order job writes a failed record, with the time its next attempt is due, to its retry topic.  A second query reads that
topic: each record is one row of keyed state, and those due at one time share the timers of ``SHARDS`` keys, so the number of
calls to the state does not grow with the records; when a timer fires its records leave the state and go through the same
attempt as any other, and a further failure is one more record of the retry topic.  Nothing is listed by due time, and pending
records survive a restart in the checkpoint.  The state holds one row a pending record.
"""

from __future__ import annotations

import datetime as dt
import itertools
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderflow import schemas as S
from orderflow.session import path_exists, prepare_processors
from orderflow.streaming import jobs as J

PENDING = T.StructType([*S.ENVELOPE.fields, T.StructField("attempt", T.IntegerType()), T.StructField("dueAt", T.TimestampType())])
KEY = ["topic", "partition", "offset", "attempt"]
#: Keys that the records due at one time are dealt to by a hash: a key holds this share of one micro-batch's failures.
SHARDS = 1024
#: Records that go to the state in one call.
CHUNK = 1000
#: State stores for each task that can run at once.
STORES_PER_SLOT = 3
#: Megabytes of the retry topic in a micro-batch, for each task that can run at once.
SLOT_MB = 32


class HoldUntilDue(StatefulProcessor):
    """Keeps the records of a key (due time in epoch milliseconds, shard) until that time, then sends them on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._records = handle.getListState("records", PENDING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        chunk = [tuple(row[c] for c in PENDING.fieldNames()) for row in itertools.islice(rows, CHUNK)]
        while chunk:
            self._records.appendList(chunk)
            chunk = [tuple(row[c] for c in PENDING.fieldNames()) for row in itertools.islice(rows, CHUNK)]
        self._handle.registerTimer(key[0])
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = [PENDING.fieldNames().index(c) for c in KEY]
        # a record that was delivered again replaces itself
        records = {tuple(r[i] for i in at): r for r in self._records.get()}
        self._records.clear()
        for record in records.values():
            yield Row(**dict(zip(PENDING.fieldNames(), record, strict=True)))

    def close(self) -> None:
        pass


def _due_millis(due_at: str) -> Column:
    return F.ceil(F.unix_micros(due_at) / 1000)


def hold_until_due(retries: DataFrame) -> DataFrame:
    """``retries`` (a stream of ``PENDING`` rows), each once its time has come."""
    prepare_processors(retries.sparkSession, __name__)
    dealt = retries.select(_due_millis("dueAt").alias("dueMillis"), F.pmod(F.xxhash64(*KEY), F.lit(SHARDS)).alias("shard"),
                           *PENDING.fieldNames())
    return dealt.groupBy("dueMillis", "shard").transformWithState(
        statefulProcessor=HoldUntilDue(), outputStructType=PENDING, outputMode="Append", timeMode="ProcessingTime")


@dataclass
class TimedOrderJob(J.OrderStreamJob):
    """I1 with timers: ``start`` runs the order query and the retry query side by side.

    Both write the same outputs, the retry query under a tick of its own.  ``clock='logical'`` gives due times in the past
    of any wall clock, so retries follow at once and results don't depend on the time of the run; ``wall`` waits.
    """

    poll: str = "1 second"

    RETRY_TICK = 1
    _TOPIC = T.StructType([T.StructField("rec", PENDING)])

    def __post_init__(self):
        super().__post_init__()
        self.ticks_per_batch = 2
        self._taken: dict[int, int] = {}

    def process(self, batch: DataFrame, batch_id: int, tick: int = 0) -> None:
        now, _ = self._clock(batch_id, tick)
        work = batch if tick else batch.withColumn("attempt", F.lit(1))
        self._handle(work.select(*S.ENVELOPE.fieldNames(), "attempt"), now, batch_id, tick)
        if tick:
            self._taken = {batch_id: int(self._last_flow.get("taken", 0))}

    def _due_folder(self, due_at):
        return F.lit(self._NO_MINUTE)

    def retry_topic(self) -> DataFrame:
        """The retry topic as a stream of ``PENDING`` rows."""
        path = self._kind_path("retries")
        if not path_exists(self.spark, path):  # a topic is there before its first record
            self.spark.createDataFrame([], self._TOPIC).write.mode("append").parquet(path)
        # by size: an attempt's tasks leave many small files
        size = (SLOT_MB << 20) * self.spark.sparkContext.defaultParallelism
        return self.spark.readStream.schema(self._TOPIC).option("maxBytesPerTrigger", size).parquet(path).select("rec.*")

    def _beat(self) -> DataFrame:
        """A stream without rows whose source always has new offsets: after a restart Spark runs no batch, and so no timer,
        before one of its sources has something new."""
        beat = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return beat.where("value < 0").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in PENDING.fields))

    def start_retries(self, checkpoint: str):
        """The retry query, until it is stopped."""
        due = hold_until_due(self.retry_topic().unionByName(self._beat()))
        # a state store and a Python worker for each shuffle partition and micro-batch: a few for each task slot, however many
        # the session has (a checkpoint keeps the number it began with)
        conf, name = self.spark.conf, "spark.sql.shuffle.partitions"
        kept = conf.get(name)
        conf.set(name, str(min(int(kept), STORES_PER_SLOT * self.spark.sparkContext.defaultParallelism)))
        try:
            return (due.writeStream.foreachBatch(lambda df, bid: self.process(df, bid, self.RETRY_TICK)).outputMode("append")
                    .option("checkpointLocation", checkpoint).trigger(processingTime=self.poll).start())
        finally:
            conf.set(name, kept)

    def pending(self) -> int:
        """Retries that were routed and not yet taken, by the recorded flow."""
        return int(self._flow().agg(F.coalesce(F.sum(F.col("retried") - F.col("taken")), F.lit(0))).first()[0])

    def _idle(self, progress) -> bool:
        """Whether a micro-batch found no new file in the retry topic, took nothing from the state and came after the last due
        time.  The flow alone doesn't tell: a record that came twice is routed twice and taken once."""
        topic = next(s for s in progress["sources"] if s["description"].startswith("FileStreamSource"))
        if topic["startOffset"] != topic["endOffset"] or self._taken.get(progress["batchId"], 1):
            return False
        if any(int(o["numRowsTotal"]) for o in progress["stateOperators"]):
            return False
        # a session may not count the rows of the state: they are gone when a micro-batch after their time took nothing
        retries = self.spark.read.schema(self._TOPIC).option("recursiveFileLookup", "true").parquet(self._kind_path("retries"))
        last_due = retries.agg(F.max(_due_millis("rec.dueAt"))).first()[0]
        return last_due is None or dt.datetime.fromisoformat(progress["timestamp"]).timestamp() * 1000 > last_due

    def run(self, source: str, checkpoint: str, max_files: int | None = None, timeout: float | None = None) -> int:
        """Everything available in ``source`` and all its retries, then stop; ``timeout`` as in ``run_retries``."""
        q = J.run_available_now(self._records(source, max_files), lambda df, bid: self.process(df, bid), checkpoint)
        self.run_retries(f"{checkpoint}_retries", timeout)
        return J.last_batch_id(q)

    def run_retries(self, checkpoint: str, timeout: float | None = None) -> None:
        """The retry query until nothing is pending, however long it takes.

        With ``timeout`` it is an error if that takes more seconds; the checkpoint keeps what is pending for the next run."""
        if not path_exists(self.spark, self._kind_path("retries")):
            return
        q, seen, done, died = self.start_retries(checkpoint), None, False, False
        until = math.inf if timeout is None else time.monotonic() + timeout
        try:
            while time.monotonic() < until:
                if died := not q.isActive:
                    break
                last = q.lastProgress
                if last and last["batchId"] != seen:  # counted once a micro-batch
                    # the first one after a restart may have been planned before the latest records were there
                    if done := seen is not None and self._idle(last):
                        break
                    seen = last["batchId"]
                time.sleep(0.1)
        finally:
            q.stop()
        if q.exception():
            raise q.exception()
        if died:
            raise RuntimeError("the retry query ended with retries still to come")
        if not done:
            raise TimeoutError(f"the retry query was not done after {timeout:g} s, {self.pending()} retries are still to come by the "
                               "recorded flow; the next run goes on from the checkpoint")
