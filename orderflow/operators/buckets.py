"""A store that a batch rewrites only in part (A4, C2): hash buckets with versions.

Rows lie under ``data/bucket=B/version=V``; a manifest names the version of each bucket that is current.  A merge reads the
buckets its keys fall in, writes their new versions beside the old ones and commits by writing the next manifest, so readers
see all of a batch or nothing of it, a merge that died leaves nothing behind that a reader takes up, and two merges that
race can't both commit.  Merges may be replayed and come in any order, as those of ``store.merge_into_store``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators import store as ST
from orderflow.session import delete_folder, list_folders, path_exists


@dataclass
class BucketedStore:
    """Current rows by ``key`` under ``root``.  ``buckets`` is fixed when the store is made: about its bytes by 256 MB."""

    spark: SparkSession
    root: str
    seq_cols: list[str]
    key: str = "orderId"
    ingested_col: str = "ingestedAt"
    buckets: int = 64

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The committed version, -1 before the first."""
        root = f"{self.root}/manifest"
        return ST.latest_version(self.spark, root) if path_exists(self.spark, root) else -1

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """Current version of each bucket that has rows (at most ``buckets`` entries)."""
        version = self.version() if version is None else version
        if version < 0:
            return {}
        return {r["bucket"]: r["version"] for r in self.spark.read.parquet(f"{self.root}/manifest/version={version}").collect()}

    def _paths(self, buckets) -> list[str]:
        held = self.manifest()
        return [f"{self.root}/data/bucket={b}/version={held[b]}" for b in sorted(held) if buckets is None or b in buckets]

    def state(self, buckets=None) -> DataFrame | None:
        """Rows of some buckets, or all, with what later merges need; None if there are none."""
        paths = self._paths(None if buckets is None else set(buckets))
        if not paths:
            return None
        schema = self.spark.read.parquet(paths[0]).schema
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The current rows."""
        found = self.state()
        if found is None:
            raise FileNotFoundError(self.root)
        return found.drop(*ST.STATE_COLS)

    def find(self, keys: list[str]) -> DataFrame:
        """Rows of some keys (a list of a request): only their buckets are read."""
        asked = self.spark.createDataFrame([(k,) for k in keys], f"{self.key} string")
        wanted = {r[0] for r in asked.select(self.bucket_of(F.col(self.key))).distinct().collect()}
        found = self.state(wanted)
        if found is None:
            raise FileNotFoundError(self.root)
        return found.drop(*ST.STATE_COLS).where(F.col(self.key).isin(*keys))

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets that the keys of ``batch`` fall in."""
        return sorted(r[0] for r in batch.select(self.bucket_of(F.col(self.key))).distinct().collect())

    def merged(self, batch: DataFrame, touched: list[int]) -> DataFrame:
        """The new rows of ``touched`` buckets."""
        held = self.state(touched)
        if held is None:
            return ST.upsert_orders(batch, self.seq_cols, self.key, self.ingested_col, keep_state=True)
        return ST.merge_into_store(held, batch, self.seq_cols, self.key, self.ingested_col)

    def merge(self, batch: DataFrame) -> list[int]:
        """Folds a batch of arrivals into the store; returns the buckets that were rewritten.

        A null key is a key like any other.  An empty batch commits nothing."""
        touched = self.touched(batch)
        if not touched:
            return []
        version = self.version() + 1
        rows = self.merged(batch, touched).withColumns({"bucket": self.bucket_of(F.col(self.key)), "version": F.lit(version)})
        (rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", self.key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .partitionBy("bucket", "version").parquet(f"{self.root}/data"))
        held = self.manifest(version - 1) | dict.fromkeys(touched, version)
        schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("version", T.IntegerType())])
        # fails if another merge has committed this version
        self.spark.createDataFrame(sorted(held.items()), schema).coalesce(1).write.parquet(f"{self.root}/manifest/version={version}")
        return touched

    def vacuum(self, keep: int = 2) -> int:
        """Removes bucket versions and manifests that none of the last ``keep`` versions names; returns how many folders went."""
        last = self.version()
        kept = [v for v in range(max(0, last - keep + 1), last + 1)]
        named = {(b, v) for k in kept for b, v in self.manifest(k).items()}
        gone = 0
        for folder in list_folders(self.spark, f"{self.root}/data"):
            bucket = int(folder.partition("=")[2])
            for name in list_folders(self.spark, f"{self.root}/data/{folder}"):
                if (bucket, int(name.partition("=")[2])) not in named:
                    gone += delete_folder(self.spark, f"{self.root}/data/{folder}/{name}")
        for name in list_folders(self.spark, f"{self.root}/manifest"):
            if 0 <= int(name.partition("=")[2]) < kept[0] if kept else False:
                gone += delete_folder(self.spark, f"{self.root}/manifest/{name}")
        return gone
