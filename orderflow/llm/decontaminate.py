"""Operator 5: benchmark decontamination with a broadcast hash set of normalised n-grams.

The windows of the benchmark (``n`` consecutive words; a shorter item is one window) are numbered by word and held in
a hash table, which is broadcast: a block of it holds at most ``block_chars`` characters of items. A benchmark beyond
that is cut into blocks by item, each scanned against all documents. A document's words become numbers (words that no
item has: -1), windows of known words are looked up, and a hit is verified by its whole tuple of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import by_row, saved

#: Bytes to words: A-Z to lower case, other ASCII but a-z and 0-9 to a space, bytes of other characters as they are.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Characters of benchmark items in one broadcast table; it takes some 30 bytes for each.
BLOCK_CHARS = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class WindowTable:
    """Windows of benchmark items by length: tuple of word numbers to the items that hold it."""

    def __init__(self, items: list[tuple[object, str | None]], n: int):
        self.words: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                self.windows.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), set()).add(item)

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], list]:
        """Runs of hit words as [start, end), and the items whose windows occur."""
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        edge, items = np.zeros(len(words) + 1, np.int64), set()
        for size, table in self.windows.items():
            for i in np.flatnonzero(known[size:] - known[:-size] == size) if len(words) >= size else ():
                if found := table.get(tuple(ids[i:i + size].tolist())):
                    items |= found
                    edge[i] += 1
                    edge[i + size] -= 1
        hit = np.concatenate(([0], np.cumsum(edge[:-1]) > 0, [0])).astype(np.int8)
        step = np.diff(hit)
        spans = np.column_stack((np.flatnonzero(step == 1), np.flatnonzero(step == -1))).tolist()
        return spans, sorted(x for x in items if x is not None)


def _tables(benchmark: DataFrame, n: int, item_col: str, text_col: str, block_chars: int) -> Iterator[WindowTable]:
    """Window tables of blocks of items; each holds about ``block_chars`` characters (an item isn't cut)."""
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    blocks = -(-(tests.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for b in range(blocks):
        yield WindowTable([tuple(r) for r in tests.where(block == b).collect()], n)


def _scanned(docs: DataFrame, table: WindowTable, item_type: T.DataType) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            found = [shared.value.scan(w) for w in words]
            yield pd.DataFrame({"id": batch["id"], "text": batch["text"], "n_words": [len(w) for w in words],
                                "spans": [s for s, _ in found], "items": [i for _, i in found]})

    out = f"text string, n_words long, spans array<array<long>>, items array<{item_type.simpleString()}>"
    return by_row(docs, scan, "id", out, text="text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each row of ``docs``: id, text, n_words, spans, items.

    ``spans``: maximal runs [start, end) of hit words; ``items``: ids of the items with an occurring window. A null or
    empty text has no words and no hit, as item or as document; an item without words has no windows; items with a
    null id hit words but aren't listed. Repeated documents get a row each, repeated items count once. An empty
    benchmark hits nothing, an empty ``docs`` gives no rows. Other columns are left out, whatever their names.
    """
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_col].dataType
    parts = [_scanned(read, t, item_type) for t in _tables(benchmark, n, item_col, item_text_col, block_chars)]
    if len(parts) == 1:
        return parts[0].withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)
    # equal rows get equal results in every block, so the blocks' hits meet by id and text digest
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    hits = parts[0].select("id", key.alias("_key"), "spans", "items")
    for part in parts[1:]:
        hits = hits.unionByName(part.select("id", key.alias("_key"), "spans", "items"))
    hits = hits.where(F.size("spans") > 0).distinct().groupBy("id", "_key").agg(
        F.flatten(F.collect_list("spans")).alias("found"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("named"))
    merged = F.aggregate(F.array_sort("found"), F.expr("cast(array() as array<array<bigint>>)"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.get(F.element_at(acc, -1), F.lit(1)) >= F.get(s, F.lit(0))),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.array(
            F.get(F.element_at(acc, -1), F.lit(0)),
            F.greatest(F.get(F.element_at(acc, -1), F.lit(1)), F.get(s, F.lit(1)))))),
    ).otherwise(F.concat(acc, F.array(s))))
    hits = hits.select(F.col("id").alias("_id"), F.col("_key").alias("_k"), merged.alias("found"), "named")
    base = parts[0].select("id", "text", "n_words", key.alias("_key"))
    joined = base.join(hits, base["id"].eqNullSafe(hits["_id"]) & (base["_key"] == hits["_k"]), "left")
    return joined.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_words",
                         F.coalesce("found", F.expr("cast(array() as array<array<bigint>>)")).alias("spans"),
                         F.coalesce("named", F.array().cast(T.ArrayType(item_type))).alias("items"))


def n_hit() -> Column:
    """Hit words of a row of ``decontaminate``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    items = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return scanned.select(id_col, "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                          (n_hit() > 0).alias("contaminated"))


def _is_clean(shared):
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not shared.value.scan(words_of(t))[0] for t in texts], dtype=bool)

    clean.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(clean, T.BooleanType())


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay.

    A row is judged by its text alone: a null text is clean, and repeated rows go or stay together.
    """
    shared = None
    for table in _tables(benchmark, n, item_col, item_text_col, block_chars):
        if shared is not None:  # a worker holds one block's table: what a block left is written before the next one
            docs = saved(docs, "decontamination_block")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(table)
        docs = docs.where(_is_clean(shared)(F.col(text_col)))
    return docs
