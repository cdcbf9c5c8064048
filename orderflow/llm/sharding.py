"""Operator 9: sharding by a minimax contiguous partition, with DataFrame functions only.

Rows of equal text are an atomic group that no shard boundary may cut. Groups stand in the order of a 60-bit key (the
head of the text's SHA-256), which a row can work out by itself. Sought is the smallest capacity with which ``n`` runs
of whole groups hold everything; it is found by binary search, each capacity checked by filling shards greedily.

The order is never gathered: the search runs over sums of key ranges, at first 4096 of them. A range that the search
has to cut is summed again at a finer grain, for all such ranges in one query, until it is cut between single groups.
What reaches the driver is these sums. The cuts then are ``n - 1`` keys, and a row's shard follows from its own key.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved

KEY_BITS = 60
STEP_BITS = 12
#: Rows that are numbered together in one window.
NUMBERED_ROWS = 20_000


def text_key(text: Column) -> Column:
    """The first 60 bits of the text's SHA-256; null counts as a text of its own, first in order."""
    return F.coalesce(F.conv(F.substring(F.sha2(text, 256), 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(0).cast("long"))


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


@dataclass
class Ranges:
    """Sums of key ranges in order: ``low`` key, ``bits`` of width (0: one key), ``size``."""

    low: list[int]
    bits: list[int]
    size: list[int]

    def __post_init__(self):
        self.until = list(accumulate(self.size))

    def fill(self, capacity: int, shards: int, split: bool) -> list[int] | None:
        """Greedy cuts as sizes before each cut; None if ``shards`` shards don't hold everything.

        A range that has to be cut, but isn't one key, is cut exactly at capacity if ``split`` (no real filling
        reaches further), else it is left to the next shard whole (a real filling that may stop too early).
        """
        at, cuts = 0, []
        for _ in range(shards):
            if at >= self.until[-1]:
                break
            i = bisect_right(self.until, at + capacity)
            if i == len(self.until):
                at = self.until[-1]
            elif split and self.bits[i]:
                at += capacity
            else:
                whole = self.until[i - 1] if i else 0
                if whole <= at:
                    return None
                at = whole
            cuts.append(at)
        return cuts if at >= self.until[-1] else None

    def least(self, shards: int, split: bool) -> int:
        """The smallest capacity that ``fill`` finds feasible."""
        low, high = -(-self.until[-1] // shards), self.until[-1]
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fill(middle, shards, split) else (middle + 1, high)
        return low

    def cut_ranges(self, cuts: list[int]) -> set[int]:
        """Ranges of more than one key that a cut falls into or stands beside."""
        near = {j for c in cuts for i in [bisect_right(self.until, c)] for j in (i - 1, i)}
        return {i for i in near if 0 <= i < len(self.low) and self.bits[i]}


def _sums(groups: DataFrame, ranges: list[tuple[int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """For each (low, bits): the sums of its parts, a 4096th each; one query."""
    part, keep = F.lit(None).cast("long"), F.lit(False)
    for low, bits in ranges:
        inside = F.col("key").between(low, low + (1 << bits) - 1)
        part = F.when(inside, F.shiftright("key", bits - STEP_BITS) * F.lit(1 << (bits - STEP_BITS))).otherwise(part)
        keep = keep | inside
    rows = groups.where(keep).groupBy(part.alias("low")).agg(
        F.sum("size").alias("size"), F.min("key").alias("first"), F.max("key").alias("last")).collect()
    found: dict[int, list[tuple[int, int, int]]] = {low: [] for low, _ in ranges}
    order = sorted(ranges)
    for r in sorted(rows):
        low, bits = order[bisect_right(order, (r["low"], KEY_BITS + 1)) - 1]
        alone = r["first"] == r["last"]  # one group: no finer part
        found[low].append((r["first"], 0, r["size"]) if alone else (r["low"], bits - STEP_BITS, r["size"]))
    return found


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """First keys of the shards but the first, such that the largest shard is as small as can be.

    ``groups``: key, size; keys may recur, equal keys stay together. At most two ranges for each cut of either bound
    are refined in a round, so a round returns at most some 4096 times that many sums.
    """
    parts = _sums(groups, [(0, KEY_BITS)])[0]
    while parts:
        ranges = Ranges(*map(list, zip(*parts, strict=True)))
        floor, ceiling = ranges.least(shards, True), ranges.least(shards, False)
        lowest, highest = ranges.fill(floor, shards, True), ranges.fill(ceiling, shards, False)
        open_ranges = ranges.cut_ranges(lowest) | ranges.cut_ranges(highest)
        if not open_ranges:
            starts = [bisect_right(ranges.until, c) for c in highest]
            return [ranges.low[i] if i < len(ranges.low) else 1 << KEY_BITS for i in starts][: shards - 1]
        finer = _sums(groups, [(ranges.low[i], ranges.bits[i]) for i in sorted(open_ranges)])
        parts = [y for i, x in enumerate(parts) for y in (finer[x[0]] if i in open_ranges else [x])]
    return []


def minimax_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, key, size, text_crc32, shard, slot.

    ``size``: UTF-8 bytes of the text (null: none) plus 1; ``shard``: 0 to ``shards`` - 1, the largest as small as
    equal texts in one shard allow; ``slot``: 0 up in each shard. Null texts are one group, apart from empty ones.
    Repeated rows have a slot each. An empty table gives no rows; with few groups shards may stay empty. Other columns
    are left out, whatever their names.
    """
    text = F.col(text_col)
    rows = saved(docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"), text_size(text).alias("size"),
                             F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32")), "shard_rows")
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard_groups")
    shard = F.lit(0)
    for cut in minimax_cuts(groups, shards):
        shard = shard + F.when(F.col("key") >= F.lit(cut), 1).otherwise(0)
    # numbered in small lots, each from where the lots before it end; lots by id and key, so no group or shard is one task
    n = groups.agg(F.sum("n")).first()[0] or 0
    lots = max(1, -(-n // NUMBERED_ROWS))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "lot", F.pmod(F.xxhash64("id", "key", "size"), F.lit(lots)).cast("int"))
    counted = placed.groupBy("shard", "lot").count()
    before = counted.select(F.col("shard").alias("_shard"), F.col("lot").alias("_lot"), F.coalesce(F.expr(
        "sum(count) over (partition by shard order by lot rows between unbounded preceding and 1 preceding)"), F.lit(0)).alias("before"))
    within = placed.withColumn("place", F.expr("row_number() over (partition by shard, lot order by id, key)") - 1)
    return within.join(before, (F.col("shard") == F.col("_shard")) & (F.col("lot") == F.col("_lot"))).select(
        F.col("id").alias(id_col), "key", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))


def digest(sharded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return sharded.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The whole rows of ``docs``, in a folder for each shard; a row's shard is worked out from its key again."""
    cuts = sharded.groupBy("shard").agg(F.min("key").alias("low")).orderBy("shard").collect()
    shard = F.lit(None).cast("int")
    for r in cuts:
        shard = F.when(text_key(F.col(text_col)) >= F.lit(r["low"]), F.lit(r["shard"])).otherwise(shard)
    docs.withColumn("shard", shard).write.mode("overwrite").partitionBy("shard").parquet(path)
