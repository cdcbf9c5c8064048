"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import ensure_defaults, scratch_path

#: Rows per Arrow batch: with whole texts of a few kB a batch is a few MB; very long texts are bounded by bytes.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings of every query here: Arrow batches small enough for whole texts; workers can import the package."""
    ensure_defaults(spark)
    ship(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))):
        spark.conf.set(key, value)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session: their Python workers import it to run its functions."""
    context = spark.sparkContext
    if getattr(context, "_orderflow_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = f"{tempfile.mkdtemp(prefix='orderflow-')}/orderflow_package.zip"  # served by the driver
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    context._orderflow_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_row(df: DataFrame, fn: Callable, id_col: str, out: str, **columns: str) -> DataFrame:
    """``fn``, over pandas batches, for the id and ``columns`` (name: column of ``df``); all else is left out.

    The id travels as text and comes back in its type: pandas has no whole numbers beside nulls.
    """
    read = df.select(F.col(id_col).cast("string").alias("id"), *(F.col(c).alias(name) for name, c in columns.items()))
    made = read.mapInPandas(fn, f"id string, {out}")
    return made.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


@lru_cache(1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(text: str | None) -> bytes | None:
    return None if text is None else _zstd()[0].compress(text.encode("utf-8", "surrogatepass"))


def unpack(packed: bytes | None) -> str | None:
    return None if packed is None else _zstd()[1].decompress(packed).decode("utf-8", "surrogatepass")


def packed(column: str) -> Column:
    """Text in less than half its bytes, for a shuffle."""
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([pack(t) for t in texts], dtype=object)

    each.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(each, "binary")(F.col(column))


def unpacked(column: str) -> Column:
    def each(values: pd.Series) -> pd.Series:
        return pd.Series([unpack(v) for v in values], dtype=object)

    each.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(each, "string")(F.col(column))


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: computed once, and its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
