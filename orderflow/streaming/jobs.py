"""Structured Streaming jobs.

Sources are Kafka when the connector is on the classpath, else a file source
with the same envelope columns (``key, value, topic, partition, offset,
timestamp``).  Every sink is ``foreachBatch`` writing one folder per batch id
with ``overwrite``: a batch that is replayed after a failure rewrites exactly
its own output, so together with the checkpoint the jobs are idempotent and
survive lost executors or a driver restart.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.operators import documents as D
from orderflow.operators import feed as FD
from orderflow.operators import retry as R
from orderflow.session import any_path, delete_folder, list_folders, path_exists


# ------------------------------------------------------------------ plumbing
def read_order_stream(spark: SparkSession, source: str, fmt: str = "parquet", schema: T.StructType = S.ENVELOPE,
                      max_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """A1: the order topic as a streaming DataFrame of envelope rows.

    ``fmt='kafka'``: ``source`` is the topic (``subscribe``), the per-trigger
    cap maps to ``maxOffsetsPerTrigger`` and the consumer group / commit is the
    checkpoint.  Any file format: ``source`` is a folder and the cap maps to
    ``maxFilesPerTrigger`` (by default a few files for each task slot)."""
    options = dict(options or {})
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", source)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        raw = r.options(**options).load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                          "offset", "timestamp")
    r = spark.readStream.schema(schema).format(fmt)
    r = r.option("maxFilesPerTrigger", max_per_trigger or files_per_trigger(spark))
    return r.options(**options).load(source)


MAX_RECORDS_PER_FILE = 1_000_000


#: Source files of a micro-batch for each task slot: a few, so that slots that end early go on with the next file and what a
#: micro-batch costs besides its rows is paid less often.
FILES_PER_SLOT = 4


def files_per_trigger(spark: SparkSession) -> int:
    """Source files of a micro-batch: some for each task that can run at once."""
    return max(1, spark.sparkContext.defaultParallelism) * FILES_PER_SLOT


def read_files(spark: SparkSession, source: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, with ``files_per_trigger``
    files a trigger (or ``max_files``)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files or files_per_trigger(spark))
            .parquet(source))


def materialize(df: DataFrame, path: str, files: int | None = None, split_col: str | None = None) -> str:
    """Write a DataFrame as Parquet files: a replayable file source standing in
    for a topic (one file ~ one slice of a partition).  Rows stay in the
    partitions they are read in (no shuffle) unless ``files`` asks for a
    number of files; no file holds more than ``MAX_RECORDS_PER_FILE`` rows."""
    if files:
        df = df.repartition(files, split_col) if split_col else df.repartition(files)
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return path


def disorder(df: DataFrame, ts_col: str) -> str:
    """A watermark delay with which no row of ``df`` is late, in whatever order
    its files are read: the span of its event times."""
    span = df.agg((F.unix_seconds(F.max(F.col(ts_col).cast("timestamp"))) - F.unix_seconds(
        F.min(F.col(ts_col).cast("timestamp")))).alias("s")).first()["s"]
    return f"{int(span or 0) + 1} seconds"


def late_rows(query) -> int:
    """Rows that the stateful operators of a finished query dropped as late."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


def batch_folder(root: str, batch_id: int, tick: int | None = None) -> str:
    p = f"{root}/batch_id={batch_id}"
    return p if tick is None else f"{p}/tick={tick}"


def write_batch(df: DataFrame, root: str, batch_id: int, tick: int | None = None) -> None:
    """Idempotent per-batch output: a replayed batch overwrites its own folder."""
    df.write.mode("overwrite").parquet(batch_folder(root, batch_id, tick))


def one_row(spark: SparkSession, schema: str, values) -> DataFrame:
    """A table of one row in one partition, made without a Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(0, 1, 1, 1).select(*(F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)))


def read_batches(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All batch folders under ``root`` (empty, with ``schema``, when nothing
    was written yet)."""
    if not path_exists(spark, root):
        if schema is None:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", root).parquet(root)


def run_available_now(stream: DataFrame, process, checkpoint: str, output_mode: str = "append"):
    """Drain everything available, then stop (``trigger(availableNow=True)``)."""
    q = (stream.writeStream.foreachBatch(process).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def last_batch_id(query) -> int:
    prog = query.lastProgress
    return int(prog["batchId"]) if prog else -1


RECORD_KEY = ("topic", "partition", "offset")


def each_once(stream: DataFrame, within: str = "1 hour", key: tuple[str, ...] = RECORD_KEY) -> DataFrame:
    """Every record of a stream once, however often the source delivers it ``within`` this time of its first arrival.

    A record is named by its place in the topic; the watermark is on the time of arrival here, so no record is late, and the
    state holds the keys of the last ``within`` only."""
    return (stream.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", within)
            .dropDuplicatesWithinWatermark(list(key)).drop("_arrival"))


def feed_once(stream: DataFrame, within: str = "1 hour") -> DataFrame:
    """A8 on a source that may deliver records again: the lean feed of every record that parses, each record once.

    The lean row goes through the shuffle that finds repeated records, not the record's text.  A record is judged after that:
    one that doesn't parse counts as delivered too."""
    ev = lambda c: F.col("event")[c]
    lean = D.parse_orders(stream).select(*RECORD_KEY, (~F.col("parseError") & FD.lean_ok(ev)).alias("_ok"), F.struct(*FD.lean_columns(ev)).alias("_feed"))
    return each_once(lean, within).filter("_ok").select("_feed.*")


# ------------------------------------------------------------- I1 / I2 / I4
OUTPUT_KINDS = ("store_log", "feed", "retries", "dead_letters", "rejected")
_REC_FIELDS = ["key", "value", "partition", "offset", "timestamp"]


@dataclass
class OrderStreamJob:
    """Consume -> parse -> store -> feed, with non-blocking retries.

    Per micro-batch: new records (attempt 1) are unioned with the retries that
    fell due since the previous tick (G1).  Records that parse and pass become
    store rows and feed rows; failures are routed (I2) to the retries, or after
    the 4th attempt to the dead letters.  All four outputs come from **one
    pass** over the batch, written by one job under
    ``out/kind=K/dueMinute=M/batch_id=N/tick=T`` with dynamic partition
    overwrite, so a replayed batch rewrites exactly its own partitions.
    Retries are laid out by due minute: a tick reads only the minute folders
    of its due window, however long the job has run.  The clock of each tick
    is recorded once (``ticks``), so a replay takes the same due retries.

    Records that a topic would not take (``documents.publish_outcome``: no key,
    no lane, more than ``max_bytes``) go to ``rejected`` and count as
    ``publishFailed``; they are not processed.  ``once_within``: records that the
    source delivers again within this time are taken once (``each_once``).

    ``fails(attempt)`` is an optional extra failure predicate (a stand-in for
    the store rejecting a write); a record that does not parse always fails.
    """

    spark: SparkSession
    root: str
    as_of: str
    topic: str = S.ORDER_TOPIC
    tick_seconds: int = 10
    fails: object = None
    ticks_per_batch: int = S.MAX_ATTEMPTS + 1
    clock: str = "logical"
    max_bytes: int = S.MAX_RECORD_BYTES
    once_within: str | None = None
    paths: dict = field(default_factory=dict)

    _FLOW = "published long, processed long, retried long, deadLettered long, taken long, publishFailed long"
    _TICK = "now timestamp"
    _SHORT_WINDOW = 60
    _NO_MINUTE = "none"

    def __post_init__(self):
        longest = min(S.BACKOFF_BASE_MS * S.BACKOFF_MULTIPLIER ** (S.MAX_ATTEMPTS - 2), S.BACKOFF_MAX_MS)
        if self.tick_seconds * 1000 < longest:
            raise ValueError(f"tick_seconds must be at least the longest retry delay, {longest / 1000:g} s: "
                             "a drain tick takes all retries of the tick before")
        for name in ("out", "ticks", "flow"):
            self.paths[name] = f"{self.root}/{name}"

    # ---- clock: logical (deterministic, for tests and replays) or wall
    def _now(self, batch_id: int, tick: int):
        if self.clock == "wall":
            return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        n = batch_id * self.ticks_per_batch + tick
        return dt.datetime.fromisoformat(self.as_of) + dt.timedelta(seconds=n * self.tick_seconds)

    def _ticks_of(self, batch_id: int) -> dict:
        """Recorded {tick: now} of one batch.  Read from the tick log the first
        time this process touches the batch (e.g. after a restart), then kept
        in memory together with the ticks this process records."""
        cache = self.__dict__.setdefault("_tick_cache", {})
        if batch_id not in cache:
            path = f"{self.paths['ticks']}/batch_id={batch_id}"
            rows = []
            if batch_id >= 0 and path_exists(self.spark, path):
                rows = (self.spark.read.schema(f"{self._TICK}, tick int").option("basePath", path)
                        .parquet(path).collect())
            cache[batch_id] = {r["tick"]: r["now"] for r in rows}
            for old in [b for b in cache if b < batch_id - 1]:  # a clock needs its own batch and the one before
                del cache[old]
        return cache[batch_id]

    def _clock(self, batch_id: int, tick: int):
        """(now, previous tick's now).  Micro-batch ids are consecutive, so the
        previous tick is in this batch or the one before: two folders."""
        mine = self._ticks_of(batch_id)
        now = mine.get(tick)
        if now is None:
            now = self._now(batch_id, tick)
            write_batch(one_row(self.spark, self._TICK, [now]), self.paths["ticks"], batch_id, tick)
            mine[tick] = now
        earlier = [n for t, n in mine.items() if t < tick]
        if not earlier:
            earlier = list(self._ticks_of(batch_id - 1).values())
        return now, (max(earlier) if earlier else None)

    # ---- output layout
    def _kind_path(self, kind: str) -> str:
        return f"{self.paths['out']}/kind={kind}"

    def output(self, kind: str) -> DataFrame | None:
        """One output kind over all batches, with ``batch_id``/``tick``;
        None before anything of that kind was written, or if all of it was cleared."""
        col = {"store_log": "doc", "feed": "feed"}.get(kind, "rec")
        path = self._kind_path(kind)
        if not any_path(self.spark, f"{path}/dueMinute=*/batch_id=*"):
            return None
        return (self.spark.read.option("basePath", path).parquet(path)
                .select(f"{col}.*", "batch_id", "tick"))

    def dead_letter_folder(self) -> str:
        """The dead-letter output, readable as a (partitioned) file stream."""
        return self._kind_path("dead_letters")

    def _due_retries(self, batch_id: int, tick: int, now, prev):
        """Retries due in (prev, now]: only the due-minute folders of the
        window are read (explicit paths: no listing of the whole history)."""
        if prev is None:
            return None
        base = self._kind_path("retries")
        first, last = (x.strftime("%Y%m%d%H%M") for x in (prev, now))
        minutes = int((now - prev).total_seconds() // 60) + 2
        if minutes <= self._SHORT_WINDOW:  # the usual tick: the window's own minutes, nothing is listed
            names = [f"dueMinute={(prev + dt.timedelta(minutes=k)).strftime('%Y%m%d%H%M')}" for k in range(minutes)]
            names = [n for n in names if n <= f"dueMinute={last}" and path_exists(self.spark, f"{base}/{n}")]
        else:  # after a long pause: one listing, however long the window
            names = [n for n in list_folders(self.spark, base) if n.startswith("dueMinute=") and first <= n.partition("=")[2] <= last]
        paths = [f"{base}/{n}" for n in names]
        if not paths:
            return None
        r = self.spark.read.option("basePath", base).parquet(*paths)
        b, t = F.col("batch_id"), F.col("tick")
        # written by an earlier tick (never the folder this tick overwrites)
        earlier = (b < batch_id) | ((b == batch_id) & (t < tick))
        due = (F.col("rec.dueAt") > F.lit(prev).cast("timestamp")) & (F.col("rec.dueAt") <= F.lit(now).cast("timestamp"))
        return r.filter(earlier & due).select("rec.*").select(*S.ENVELOPE.fieldNames(), "attempt")

    def process(self, batch: DataFrame, batch_id: int, tick: int = 0) -> None:
        now, prev = self._clock(batch_id, tick)
        work = batch.select(*S.ENVELOPE.fieldNames()).withColumn("attempt", F.lit(1))
        due = self._due_retries(batch_id, tick, now, prev)
        if due is not None:
            work = work.unionByName(due)
        self._handle(work, now, batch_id, tick)

    def _handle(self, work: DataFrame, now_value, batch_id: int, tick: int) -> None:
        """Every attempt of ``work`` (envelope and ``attempt``) as of one clock
        reading: all outputs in one pass, the flow counters observed on it."""
        now = F.lit(now_value).cast("timestamp")
        parsed = D.publish_outcome(D.parse_orders(work), self.max_bytes)
        # a record that the topic would not take never arrives: it is kept apart, not tried again
        rejected = (F.col("attempt") == 1) & ~F.col("published")
        ok = ~F.col("parseError") & ~rejected
        if self.fails is not None:
            ok = ok & ~self.fails(F.col("attempt"))
        parsed = parsed.withColumns({"ok": ok, "publishFailed": rejected})
        # D19 live: counters observed on the same pass (no extra job)
        obs = Observation(f"flow-{batch_id}-{tick}")
        parsed = parsed.observe(
            obs,
            F.count_if((F.col("attempt") == 1) & ~F.col("publishFailed")).alias("published"),
            F.count_if(F.col("ok")).alias("processed"),
            F.count_if(~F.col("ok") & ~F.col("publishFailed") & (F.col("attempt") < S.MAX_ATTEMPTS)).alias("retried"),
            F.count_if(~F.col("ok") & ~F.col("publishFailed") & (F.col("attempt") >= S.MAX_ATTEMPTS)).alias("deadLettered"),
            F.count_if(F.col("attempt") > 1).alias("taken"),
            F.count_if(F.col("publishFailed")).alias("publishFailed"),
        )

        ev = lambda c: F.col("event")[c]
        doc = F.struct(*D.document_columns(ev, "SUCCESS", now, F.col("partition"), F.col("offset"),
                                           F.col("topic")), now.alias("ingestedAt"))
        feed = F.struct(*FD.lean_columns(ev), F.col("offset"), F.col("topic"))
        route = R.route_columns(F.col("attempt"), now, F.lit(self.topic))
        rec = F.struct(*[F.col(c) for c in _REC_FIELDS], route["nextTopic"].alias("topic"),
                       route["nextAttempt"].alias("attempt"), route["dueAt"].alias("dueAt"))
        types = parsed.select(doc.alias("doc"), feed.alias("feed"), rec.alias("rec")).schema
        null = {f.name: F.lit(None).cast(f.dataType) for f in types.fields}
        none = F.lit(self._NO_MINUTE)

        def out(kind, minute, d, f, r):
            return F.struct(F.lit(kind).alias("kind"), minute.alias("dueMinute"), d.alias("doc"), f.alias("feed"),
                            r.alias("rec"))

        ok_c, refused, dead = F.col("ok"), F.col("publishFailed"), route["deadLetter"]
        rows = F.array(
            F.when(ok_c, out("store_log", none, doc, null["feed"], null["rec"])),
            F.when(ok_c & FD.lean_ok(ev), out("feed", none, null["doc"], feed, null["rec"])),
            F.when(~ok_c & ~refused & ~dead, out("retries", self._due_folder(route["dueAt"]), null["doc"], null["feed"], rec)),
            F.when(~ok_c & ~refused & dead, out("dead_letters", none, null["doc"], null["feed"], rec)),
            F.when(refused, out("rejected", none, null["doc"], null["feed"], rec)),
        )
        outputs = (parsed.select(F.explode(rows).alias("o")).filter(F.col("o").isNotNull()).select("o.*")
                   .withColumns({"batch_id": F.lit(batch_id), "tick": F.lit(tick)}))
        (outputs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("kind", "dueMinute", "batch_id", "tick").parquet(self.paths["out"]))
        m = obs.get
        self._last_flow = m
        counts = tuple(int(m.get(c, 0)) for c in ("published", "processed", "retried", "deadLettered", "taken", "publishFailed"))
        if any(counts):  # an idle tick adds nothing to the totals
            write_batch(one_row(self.spark, self._FLOW, counts), self.paths["flow"], batch_id, tick)

    def _due_folder(self, due_at):
        """Folder of a retry: its due minute."""
        return F.date_format(due_at, "yyyyMMddHHmm")

    def drain(self, after_batch: int) -> None:
        """Drain ticks: a micro-batch runs only when new data arrives, so
        pending retries are fed through the same function on empty batches.
        A tick spacing of at least the longest delay makes every retry due by
        the next tick, so draining stops at the first tick that routed no new
        retry (at most one tick per remaining attempt)."""
        import time
        empty = self.spark.createDataFrame([], S.ENVELOPE)
        for tick in range(1, self.ticks_per_batch):
            if self.clock == "wall":
                time.sleep(self.tick_seconds)
            self.process(empty, after_batch, tick)
            if not getattr(self, "_last_flow", {}).get("retried", 0):
                break

    def run(self, source: str, checkpoint: str, max_files: int | None = None) -> int:
        q = run_available_now(self._records(source, max_files), lambda df, bid: self.process(df, bid), checkpoint)
        last = last_batch_id(q)
        self.drain(max(last, 0))
        return last

    def _records(self, source: str, max_files: int | None = None) -> DataFrame:
        stream = read_order_stream(self.spark, source, max_per_trigger=max_files)
        return each_once(stream, self.once_within) if self.once_within else stream

    # ---- read side
    def _flow(self) -> DataFrame:
        """Observed counts of every tick; those of cleared batches are one row, written under the last of them."""
        schema = T.StructType.fromDDL(self._FLOW)
        ticks, last = read_batches(self.spark, self.paths["flow"], schema), self._flow_base()
        if last < 0:
            return ticks.select(*schema.fieldNames())
        rest = ticks.where(F.col("batch_id") > last) if "batch_id" in ticks.columns else ticks
        base = self.spark.read.schema(schema).parquet(f"{self.root}/flow_base/version={last}")
        return rest.select(*schema.fieldNames()).unionByName(base)

    def _flow_base(self) -> int:
        from orderflow.operators.store import latest_version
        root = f"{self.root}/flow_base"
        return latest_version(self.spark, root) if path_exists(self.spark, root) else -1

    def flow_counters(self) -> DataFrame:
        """D19 live: published / publish-failed / processed / dead-lettered
        totals over every tick's observed metrics."""
        f = self._flow()
        return f.agg(
            F.coalesce(F.sum("published"), F.lit(0)).cast("long").alias("published"),
            F.coalesce(F.sum("publishFailed"), F.lit(0)).cast("long").alias("publishFailed"),
            F.coalesce(F.sum("processed"), F.lit(0)).cast("long").alias("processed"),
            F.coalesce(F.sum("deadLettered"), F.lit(0)).cast("long").alias("deadLettered"),
        )

    # arrivals are ordered by the clock of the tick that stored them
    SEQ = ["ingestedAt", "batch_id", "tick", "kafkaTopic", "kafkaPartition", "kafkaOffset"]

    def dead_letter_root(self) -> str:
        return f"{self.root}/dead_letters"

    def consume_dead_letters(self):
        """I4 on this job's dead letters; their documents become part of ``store``."""
        return run_dead_letters(self.spark, self.dead_letter_folder(), self.dead_letter_root(), f"{self.root}/dead_letter_ckpt")

    def arrivals(self, after_batch: int = -1) -> DataFrame | None:
        """Store rows of the batches after ``after_batch``: stored orders, and
        the documents of dead letters once they were consumed; None if there are none."""
        log = self.output("store_log")
        if log is not None:
            log = log.filter(F.col("batch_id") > after_batch)
        folder = f"{self.dead_letter_root()}/dlq_docs"
        if any_path(self.spark, f"{folder}/batch_id=*"):
            dead = read_batches(self.spark, folder).filter(F.col("sourceBatch") > after_batch)
            dead = dead.drop("batch_id").withColumnsRenamed({"sourceBatch": "batch_id", "sourceTick": "tick"})
            log = dead if log is None else log.unionByName(dead)
        return log

    def compact(self, batch_id: int) -> str:
        """Write the state up to ``batch_id`` (a batch whose retries are
        drained) as a snapshot; ``store`` then reads it and later batches only."""
        from orderflow.operators.store import compact_store
        return compact_store(self.spark, self._state(), f"{self.root}/snapshots", version=batch_id)

    # ---- clearing
    def horizon(self) -> int:
        """The batch up to which nothing is needed any more: the least of the latest snapshot, the batch before the oldest
        retry that is still to come, and the batch before the oldest dead letter that was not consumed; -1 if there is none."""
        from orderflow.operators.store import latest_version
        root = f"{self.root}/snapshots"
        least = latest_version(self.spark, root) if path_exists(self.spark, root) else -1
        flow = self._flow().agg(F.coalesce(F.sum(F.col("retried") - F.col("taken")), F.lit(0))).first()[0]
        retries = self.output("retries")
        if flow and retries is not None:
            clock = read_batches(self.spark, self.paths["ticks"], T.StructType.fromDDL(self._TICK)).agg(F.max("now")).first()[0]
            oldest = retries.where(F.col("dueAt") > F.lit(clock)).agg(F.min("batch_id")).first()[0]
            least = min(least, least if oldest is None else oldest - 1)
        unread = self.output("dead_letters")
        if unread is not None:
            seen = f"{self.dead_letter_root()}/seen"
            if path_exists(self.spark, seen):
                read = self.spark.read.parquet(seen).select(F.col("sourceBatch").alias("batch_id")).distinct()
                unread = unread.join(read, "batch_id", "left_anti")
            oldest = unread.agg(F.min("batch_id")).first()[0]
            least = min(least, least if oldest is None else oldest - 1)
        return least

    def clear(self) -> int:
        """Removes what the job wrote for batches up to its ``horizon`` and returns how many folders went.

        The store is in the snapshot, the flow counts are kept in one row.  The clock of the horizon's own batch stays: the
        next batch reads it.  The feed goes with its batch; who reads it must have read it by the time of the snapshot."""
        last, spark = self.horizon(), self.spark
        if last < 0:
            return 0
        gone = 0
        batches = [b for b in _batches_of(spark, self.paths["flow"]) if b <= last]
        if batches and last > self._flow_base():
            schema, base = T.StructType.fromDDL(self._FLOW), self._flow_base()
            ticks = read_batches(spark, self.paths["flow"], schema).where(F.col("batch_id") <= last).where(F.col("batch_id") > base)
            total = ticks.select(*schema.fieldNames())
            if base >= 0:
                total = total.unionByName(spark.read.schema(schema).parquet(f"{self.root}/flow_base/version={base}"))
            # from here on readers take the batches up to ``last`` from this row
            total.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in schema.fieldNames())).coalesce(1).write.parquet(
                f"{self.root}/flow_base/version={last}")
        gone += sum(delete_folder(spark, f"{self.paths['flow']}/batch_id={b}") for b in batches)
        gone += sum(delete_folder(spark, f"{self.root}/flow_base/{f}") for f in list_folders(spark, f"{self.root}/flow_base")
                    if f.startswith("version=") and int(f.partition("=")[2]) < self._flow_base())
        for kind in list_folders(spark, self.paths["out"]):
            for minute in list_folders(spark, f"{self.paths['out']}/{kind}"):
                folder = f"{self.paths['out']}/{kind}/{minute}"
                batches = _batches_of(spark, folder)
                gone += sum(delete_folder(spark, f"{folder}/batch_id={b}") for b in batches if b <= last)
                if batches and max(batches) <= last and minute != f"dueMinute={self._NO_MINUTE}":
                    gone += delete_folder(spark, folder)
        gone += sum(delete_folder(spark, f"{self.paths['ticks']}/batch_id={b}") for b in _batches_of(spark, self.paths["ticks"]) if b < last)
        root = f"{self.dead_letter_root()}/dlq_docs"
        for b in _batches_of(spark, root):
            newest = spark.read.parquet(f"{root}/batch_id={b}").agg(F.max("sourceBatch")).first()[0]
            if newest is None or newest <= last:
                gone += delete_folder(spark, f"{root}/batch_id={b}")
        for name in list_folders(spark, f"{self.root}/snapshots"):
            if name.startswith("version=") and int(name.partition("=")[2]) < last:
                gone += delete_folder(spark, f"{self.root}/snapshots/{name}")
        return gone

    def _parts(self) -> tuple[DataFrame | None, DataFrame | None]:
        """The latest snapshot and the arrivals after it, None for what is not there."""
        from orderflow.operators import store as ST
        root = f"{self.root}/snapshots"
        version = ST.latest_version(self.spark, root) if path_exists(self.spark, root) else -1
        state = self.spark.read.parquet(f"{root}/version={version}").drop("ingestedAt") if version >= 0 else None
        return state, self.arrivals(version)

    def _state(self) -> DataFrame:
        from orderflow.operators import store as ST
        state, later = self._parts()
        if state is None:
            return ST.upsert_orders(later, self.SEQ, keep_state=True)
        return state if later is None else ST.merge_into_store(state, later, self.SEQ)

    def store(self, columns: list[str] | None = None) -> DataFrame:
        """The current store: last arrival per orderId, over the latest
        snapshot and the batches after it.  With ``columns`` only these are read
        and shuffled, and first arrivals only if ``id`` or ``createdAt`` is one of them."""
        from orderflow.operators import store as ST
        if columns is None or {"id", "createdAt"} & set(columns):
            whole = self._state().drop("firstSeq")
            return whole if columns is None else whole.select(*columns)
        state, later = self._parts()
        if state is not None:
            earlier = state.withColumnRenamed("updatedAt", "ingestedAt")
            later = earlier if later is None else earlier.unionByName(later, allowMissingColumns=True)
        return ST.newest_orders(later, self.SEQ).select(*columns)


def _batches_of(spark: SparkSession, folder: str) -> list[int]:
    return [int(f.partition("=")[2]) for f in list_folders(spark, folder) if f.startswith("batch_id=")]


def run_dead_letters(spark: SparkSession, dead_letter_folder: str, out_root: str, checkpoint: str):
    """I4: the dead-letter consumer as its own streaming query: A5 for records
    that parse (DLQ documents, stored as of the tick that gave them up), A6
    quarantine for those that do not.  ``dead_letter_folder`` holds files with a
    ``rec`` struct, in batch and tick folders.  Returns None when no dead letter
    was ever written."""
    if not path_exists(spark, dead_letter_folder):
        return None
    rec = T.StructType(S.ENVELOPE.fields + [T.StructField("attempt", T.IntegerType()),
                                            T.StructField("dueAt", T.TimestampType())])
    schema = T.StructType([T.StructField("rec", rec), T.StructField("batch_id", T.IntegerType()),
                           T.StructField("tick", T.IntegerType())])

    def process(batch: DataFrame, batch_id: int) -> None:
        parsed = D.parse_orders(batch.select("rec.*", F.col("batch_id").alias("sourceBatch"), F.col("tick").alias("sourceTick"))).persist()
        try:
            stamped = D.stamp_dead_letters(parsed, keep=["dueAt", "sourceBatch", "sourceTick"])
            docs = stamped.select(*D.document_columns(F.col, "DLQ", F.col("dueAt"), F.col("partition"), F.col("offset"), F.col("topic")),
                                  F.col("dueAt").alias("ingestedAt"), "sourceBatch", "sourceTick")
            write_batch(docs, f"{out_root}/dlq_docs", batch_id)
            write_batch(parsed.select("sourceBatch").distinct(), f"{out_root}/seen", batch_id)
            write_batch(D.quarantine(parsed), f"{out_root}/quarantine", batch_id)
        finally:
            parsed.unpersist()

    return run_available_now(read_files(spark, dead_letter_folder, schema), process, checkpoint)


# ----------------------------------------------------------- stateful views
def live_counters(orders: DataFrame) -> DataFrame:
    """D8's running counts on a stream (grouping sets, one state store)."""
    from orderflow.operators.metrics import dimension_counts
    return dimension_counts(orders)


def stats_feed_process(out_root: str, as_of: str):
    """A10: ``foreachBatch`` body publishing the dashboard snapshot from the
    complete-mode counter table (a few dozen rows: one per dimension value
    plus the grand total), once per micro-batch."""
    from orderflow.operators import metrics as M
    from orderflow.functions.scalars import iso_text

    def process(counters: DataFrame, batch_id: int) -> None:
        snap = M.snapshot_from_counters(counters, F.lit(as_of).cast("timestamp"))
        payload = FD.stats_json(snap.withColumn("snapshotAt", iso_text("snapshotAt")))
        write_batch(payload, out_root, batch_id)
    return process


def latest_orders(log: DataFrame, seq_cols: list[str], key: str = "orderId") -> DataFrame:
    """Streaming upsert -- ``max_by`` per key in update mode (window
    functions are rejected on streams).  State grows with distinct keys."""
    seq = F.struct(*[F.col(c) for c in seq_cols])
    data = [c for c in log.columns if c not in (key, "ingestedAt")]
    return log.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in data]), seq).alias("_cur"),
        F.min("ingestedAt").alias("createdAt"),
        F.max_by(F.col("ingestedAt"), seq).alias("updatedAt"),
    ).select(key, "_cur.*", "createdAt", "updatedAt")


def hourly_stats_stream(orders: DataFrame, ts_col: str = "createdAt", delay: str = "1 hour") -> DataFrame:
    """I8: D5 on a stream: count and revenue by tumbling one-hour windows, with
    a watermark of ``delay`` (the lateness bound; rows later than that are
    dropped and counted, see ``late_rows``)."""
    return (orders.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", delay)
            .groupBy(F.window("_ts", "1 hour"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.coalesce(F.sum("totalAmount"), F.lit(0)).cast("decimal(38,2)").alias("revenue"))
            .select(F.date_format("window.start", "yyyy-MM-dd'T'HH:00:00'Z'").alias("hour"), "count", "revenue"))


def latest_per_key(out: DataFrame, key_cols: list[str], order_col: str = "batch_id") -> DataFrame:
    """Fold an update-mode log (one row per key per batch that changed it) to
    the latest row per key."""
    data = [c for c in out.columns if c not in key_cols and c != order_col]
    return (out.groupBy(*key_cols)
            .agg(F.max_by(F.struct(*[F.col(c) for c in data]), F.col(order_col)).alias("_l"))
            .select(*key_cols, "_l.*"))
