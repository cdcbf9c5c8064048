"""The order store: append log + current view (A4), scan (A7), retention.

There is no MERGE-capable table format on the classpath, so the store is an
append-only Parquet log and the current state is derived from it: the newest
arrival per ``orderId`` by a limited window (each map task sends one row per
order, so an order that is redelivered millions of times costs one row per map
task; columns that nobody asks for are not read), and the first arrival's
sequence, where it is asked for, by a narrow aggregate.  A state that is kept
for later batches is written whole: one aggregate gives both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow import schemas as S

# carried by a state that later batches are merged into
STATE_COLS = ["firstSeq"]


def sequence(seq_cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in seq_cols])


def document_id(key: str, seq: Column, seq_cols: list[str]) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", F.col(key), *[seq[c].cast("string") for c in seq_cols]), 256), 1, 24)


def newest_orders(log: DataFrame, seq_cols: list[str], key: str = "orderId", ingested_col: str = "ingestedAt") -> DataFrame:
    """The last arrival of each key, its arrival time as ``updatedAt``; nothing of first arrivals."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in seq_cols])
    data_cols = [c for c in log.columns if c not in (key, ingested_col, "id", "createdAt", "updatedAt", *STATE_COLS)]
    return log.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") == 1).select(
        key, *data_cols, F.col(ingested_col).alias("updatedAt"))


def upsert_orders(log: DataFrame, seq_cols: list[str], key: str = "orderId",
                  ingested_col: str = "ingestedAt", keep_state: bool = False) -> DataFrame:
    """Current document per key: full replace by the **last arrival**.

    ``seq_cols`` order the arrivals (e.g. batch id, topic, partition, offset);
    ``id`` and ``createdAt`` come from the first arrival, ``updatedAt`` is the
    arrival time of the winning version.  A log that holds rows of an earlier
    state (with ``firstSeq`` and ``createdAt``) keeps what the state says of
    first arrivals; ``keep_state`` returns such a state.
    """
    first, created = sequence(seq_cols), F.col(ingested_col)
    if "firstSeq" in log.columns:
        first = F.coalesce(F.col("firstSeq"), first)
        created = F.coalesce(F.col("createdAt"), created)
    if keep_state:
        # a state is written whole: one pass and one shuffle, each map task sends one row an order, its newest version with the first arrival
        data_cols = [c for c in log.columns if c not in (key, ingested_col, "id", "createdAt", "updatedAt", *STATE_COLS)]
        newest = F.struct(*[F.col(c) for c in data_cols], F.col(ingested_col).alias("updatedAt"))
        out = log.groupBy(key).agg(F.max_by(newest, sequence(seq_cols)).alias("_newest"), F.min(first).alias("firstSeq"),
                                   F.min(created).alias("createdAt")).select(key, "_newest.*", "firstSeq", "createdAt")
        return out.withColumn("id", document_id(key, F.col("firstSeq"), seq_cols)).select(
            "id", key, *data_cols, "createdAt", "updatedAt", *STATE_COLS)
    current = newest_orders(log, seq_cols, key, ingested_col)
    # the first arrival: narrow columns only
    began = log.select(F.col(key).alias("_key"), first.alias("_first"), created.alias("_created")).groupBy("_key").agg(
        F.min("_first").alias("firstSeq"), F.min("_created").alias("createdAt"))
    out = current.join(began, current[key].eqNullSafe(began["_key"])).withColumn("id", document_id(key, F.col("firstSeq"), seq_cols))
    data_cols = [c for c in current.columns if c not in (key, "updatedAt")]
    return out.select("id", key, *data_cols, "createdAt", "updatedAt")


def merge_into_store(state: DataFrame, batch: DataFrame, seq_cols: list[str], key: str = "orderId",
                     ingested_col: str = "ingestedAt") -> DataFrame:
    """Incremental form: the new state from the previous one (``keep_state``)
    plus one batch of arrivals.  The state carries the sequence of each key's
    first arrival and of its current version, so that batches may be replayed
    or come in any order: the outcome is that of one upsert over all rows."""
    previous = state.withColumn(ingested_col, F.col("updatedAt")).drop("id", "updatedAt")
    return upsert_orders(previous.unionByName(batch, allowMissingColumns=True), seq_cols, key, ingested_col, keep_state=True)


def compact_store(spark: SparkSession, current: DataFrame, root: str, version: int | None = None) -> str:
    """Write the current view as snapshot ``root/version=N`` (the next one, if
    ``version`` isn't given) and return its path.  Readers switch to the new version only after it is
    complete (the folder name is the commit), the log up to it can then be
    dropped, and the written table cuts the lineage of the incremental
    merges.  Rows are clustered by ``orderId`` so the next merge's shuffle
    reads sorted files."""
    from orderflow.session import path_exists
    if version is None:
        version = latest_version(spark, root) + 1 if path_exists(spark, root) else 0
    path = f"{root}/version={version}"
    current.repartition("orderId").sortWithinPartitions("orderId").write.mode("overwrite").parquet(path)
    return path


def latest_version(spark: SparkSession, root: str) -> int:
    """Highest complete snapshot version under ``root`` (-1 when none)."""
    from orderflow.session import path_exists
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(root)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = []
    for st in fs.listStatus(fs_path):
        name = st.getPath().getName()
        if name.startswith("version=") and path_exists(spark, f"{root}/{name}/_SUCCESS"):
            versions.append(int(name.split("=", 1)[1]))
    return max(versions) if versions else -1


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={latest_version(spark, root)}")


def scan_orders(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a stored collection with its declared schema (no inference)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_store(docs: DataFrame, path: str, ts_col: str = "eventTimestamp", mode: str = "overwrite",
                grain: str = "day", id_cols: tuple[str, ...] = ("orderId", "customerId")) -> None:
    """Store layout that replaces the document store's indexes: one folder per
    event day or month (partition pruning, cheap retention), rows clustered by
    status, region and time inside each file (min/max pruning) and Bloom filters
    on the ids.  Rows are rebalanced by folder: a hot day, or rows without a
    time, are split over as many tasks as their size asks for."""
    col = {"day": "event_date", "month": "event_month"}[grain]
    day = F.to_date(ts_col)
    dated = docs.withColumn(col, day if grain == "day" else F.trunc(day, "month"))
    writer = (dated.hint("rebalance", F.col(col)).sortWithinPartitions(col, "status", "region", ts_col)
              .write.mode(mode).partitionBy(col))
    for c in id_cols:
        if c in docs.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


#: Buckets of an id table; a join meets them with as many partitions.
ID_BUCKETS = 64


def write_id_table(docs: DataFrame, path: str, key: str = "orderId", buckets: int = ID_BUCKETS, name: str | None = None) -> str:
    """The distinct ids of ``docs`` as a bucketed and sorted table under ``path``; returns its name in the session's catalog.

    A join or aggregate by the id reads it in place, without a shuffle of the stored side."""
    name = name or f"order_ids_{uuid.uuid4().hex}"
    (docs.select(key).where(F.col(key).isNotNull()).distinct().repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return name


def apply_retention(docs: DataFrame, as_of: Column, days: int = S.RETENTION_DAYS,
                    ts_col: str = "eventTimestamp") -> DataFrame:
    """Drop rows older than ``days`` (TTL on the event time).  Rows with no
    event time never expire.  On a partitioned store the same predicate
    prunes whole ``event_date`` folders."""
    cutoff = as_of - F.expr(f"INTERVAL {days * 86400} SECONDS")
    return docs.filter(F.col(ts_col).isNull() | (F.col(ts_col) > cutoff))


def drop_expired(spark: SparkSession, path: str, as_of: str, days: int = S.RETENTION_DAYS) -> list[str]:
    """Remove the date folders of a store that lie wholly before the retention
    cutoff, and return their names.  Rows without a time (the default folder)
    and the folder that the cutoff falls into stay; ``apply_retention`` hides
    the expired rows of the latter."""
    import datetime as dt
    cutoff = dt.datetime.fromisoformat(as_of) - dt.timedelta(days=days)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        kind, _, value = name.partition("=")
        if kind not in ("event_date", "event_month") or value.startswith("__"):
            continue
        first = dt.datetime.fromisoformat(value)
        after = first + dt.timedelta(days=1) if kind == "event_date" else (first + dt.timedelta(days=32)).replace(day=1)
        if after <= cutoff:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
