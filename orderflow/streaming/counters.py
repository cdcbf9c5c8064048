"""Live counters kept in, read from and repaired through the state store.

Counters are additive: an order is one row (dimension, value, 1) for each dimension, and a stream sums them by dimension and
value.  The state store is the only copy: reading the counters reads its few rows through the state data source, whatever
the number of updates behind them.  A second input takes corrections, rows of the same form.  An audit compares the state
with a recount of the store; repairing replaces every counter that differs by writing the difference as a correction, which
the stream takes up exactly once.  A restart seeds a new checkpoint with the recount as its first input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators import metrics as M
from orderflow.session import list_folders, path_exists
from orderflow.streaming import jobs as J

ROWS = T.StructType([T.StructField("dimension", T.StringType()), T.StructField("value", T.StringType()), T.StructField("n", T.LongType())])


def counter_rows(orders: DataFrame) -> DataFrame:
    """One row for each order and dimension, null values under their defaults (as ``metrics.dimension_counts``)."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in M.DIMENSIONS))
    return M.with_default_dimensions(orders).select(F.explode(pairs).alias("p")).select("p.*", F.lit(1).cast("long").alias("n"))


@dataclass
class LiveCounters:
    """Counters of one generation under ``root``; ``restart`` begins a new one."""

    spark: SparkSession
    root: str

    def generation(self) -> str:
        """Folder of the latest generation: its checkpoint and its corrections."""
        return f"{self.root}/gen={max((int(f[4:]) for f in list_folders(self.spark, self.root) if f.startswith('gen=')), default=0)}"

    def checkpoint(self) -> str:
        return f"{self.generation()}/checkpoint"

    def correct(self, rows: DataFrame) -> None:
        """Hands ``rows`` (dimension, value, n) to the stream; its next batch adds them once."""
        rows.select(*ROWS.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.generation()}/corrections")

    def run(self, orders: DataFrame) -> None:
        """Takes up everything available in ``orders`` (a stream) and in the corrections, then stops."""
        folder = f"{self.generation()}/corrections"
        if not path_exists(self.spark, folder):
            self.correct(self.spark.createDataFrame([], ROWS))
        rows = counter_rows(orders).unionByName(J.read_files(self.spark, folder, ROWS))
        counts = rows.groupBy("dimension", "value").agg(F.sum("n").alias("orders"))
        # the result is the state itself; the sink only drives the batches
        J.run_available_now(counts, lambda df, _: df.write.format("noop").mode("overwrite").save(), self.checkpoint(), "update")

    def read(self) -> DataFrame:
        """(dimension, value, orders) as of the last committed batch: a row a counter, none for one that fell to zero."""
        state = self.spark.read.format("statestore").load(self.checkpoint())
        total = state.schema["value"].dataType.fieldNames()[0]
        return state.select("key.dimension", "key.value", F.col(f"value.{total}").alias("orders")).where("orders <> 0")

    def audit(self, recount: DataFrame) -> DataFrame:
        """(dimension, value, live, store, diff) for every counter of the state or of ``recount`` (dimension, value, orders).

        The recount must cover the events that the counters have taken: audit between two runs."""
        live = self.read().withColumnRenamed("orders", "live")
        store = recount.select("dimension", "value", F.col("orders").alias("store"))
        both = live.join(store, ["dimension", "value"], "full")
        counts = {c: F.coalesce(c, F.lit(0)) for c in ("live", "store")}
        return both.withColumns(counts).withColumn("diff", F.col("live") - F.col("store"))

    def repair(self, recount: DataFrame) -> DataFrame:
        """Replaces the counters that differ from ``recount`` with the next ``run``; returns the audit, a row a counter."""
        found = self.spark.createDataFrame(self.audit(recount).collect(), "dimension string, value string, live long, store long, diff long")
        self.correct(found.where("diff <> 0").select("dimension", "value", (-F.col("diff")).alias("n")))
        return found

    def restart(self, recount: DataFrame) -> str:
        """Begins a new generation with ``recount`` as its initial state; the next ``run`` must be given a stream of the
        events after it.  Readers see the old generation until that run's folder is there."""
        after = int(self.generation().rpartition("=")[2]) + 1
        recount.select("dimension", "value", F.col("orders").alias("n")).coalesce(1).write.parquet(f"{self.root}/gen={after}/corrections")
        return f"{self.root}/gen={after}"
