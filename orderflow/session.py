"""Spark session helpers.

Library functions never build their own session: they take the caller's
``SparkSession``.  ``local_session`` is only for tests, the bench and the
driver entry point.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings every job relies on.  They are applied with ``setdefault`` semantics
# on a live session, so a cluster's own values always win.
SESSION_DEFAULTS = {
    # all time maths (hour labels, 24 h windows, ISO text) is UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffle partitions, split skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state (e.g. the latest version per order) grows with the
    # number of keys: keep it in RocksDB (off-heap, spills to local disk) and
    # checkpoint only the changes of each micro-batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "orderflow") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ORDERFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Apply SESSION_DEFAULTS where the session has no value of its own."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # hour labels, windows and ISO text are UTC by definition, so this one setting
    # replaces the session's own value
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage; a
    cluster session without it is refused, since executors would write to disks
    of their own.  On a single machine a fresh local folder is filled in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def prepare_processors(spark: SparkSession, module: str) -> None:
    """What the stateful processors of ``module`` need.

    Their Python workers, one of them beside the driver, need not find this package: the module's classes are sent by value.
    The state store must have column families. Spark's default store has none, so it is replaced for the session's new queries;
    a query that runs on keeps the store of its checkpoint."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
    provider = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(provider, ""):
        spark.conf.set(provider, SESSION_DEFAULTS[provider])


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under the checkpoint root for one job's files."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path`` (none if it isn't there)."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names
    (local, HDFS, object store), via the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a glob pattern."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Removes a folder of this library's own and all in it; whether it was there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
