"""Operator 8: n-gram Jaccard self-join with signature trees.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when the shared part of their
sets is at least three quarters of the whole. The steps, all of them exact:

1. Shingles that are frequent within some part of the corpus are counted over all of it; the most frequent ones go last in
   the order of shingles (an order alone, it changes no result).
2. Each document's first |x| - ceil(0.75 |x|) + 1 shingles in that order are such that documents that link share one of
   them; of a prefix that is longer by a twelfth of |x| they share a sixteenth of |x| and one more at least. A shingle of
   the prefix is alive if another document's prefix holds it. A document with too few alive shingles has no link. Of the
   others, the most frequent ones may be left out but for that number. Documents are clustered by what remains, rare
   shingles that they share, and links never leave a cluster. Documents with the same most frequent one are contracted
   first: from then on they are one node, which sends each further shingle once.
3. Within a cluster, signature trees find the links. A leaf's documents have bitmaps of their shingles; a node holds the
   OR of those below it and the range of their sizes. Two trees are traversed together, and a pair of nodes is dropped if
   its greatest possible overlap, or its sizes, can't reach the threshold. Pairs left at the leaves are verified on sets.
   Clusters beyond a block are split by size class and block, and pairs of blocks are tasks of their own.
4. Links are merged into components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import mix64, packed, saved, unpack, unpacked
from orderflow.llm.components import Forest, connected_components

WORDS = 5
#: Similarity of 3 / 4, in whole numbers.
NUM, DEN = 3, 4
#: A shingle is counted as frequent if it is in this share of the documents of a chunk; so many go last in the order.
FREQUENT_SHARE, FREQUENT_LEAST, FREQUENT_KEPT = 0.005, 8, 100_000
CHUNK_SHINGLES = 1_000_000
#: The prefix is longer by the set's size divided by this.
EXTRA = 12
#: Documents of a block, of a leaf, and children of a node.
BLOCK, LEAF, FANOUT = 1024, 16, 8

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes (as int64) of its shingles; fewer words are one shingle."""
    words = [words_of(t) for t in texts]
    sizes = [len(w) for w in words]
    flat = np.empty(sum(sizes), object)
    flat[:] = [x for w in words for x in w]
    each = mix64(pd.util.hash_array(flat, categorize=False)) if len(flat) else np.zeros(0, np.uint64)
    whole = np.zeros(max(0, len(each) - WORDS + 1), np.uint64)
    for j in range(WORDS):
        whole += each[j:j + len(whole)] * _M[j]
    whole = mix64(whole).view(np.int64)
    sets, at = [], 0
    for n in sizes:
        if n >= WORDS:
            sets.append(np.unique(whole[at:at + n - WORDS + 1]))
        elif n:
            part = each[at:at + n] * np.array(_M[:n])
            sets.append(mix64(np.array([part.sum(dtype=np.uint64) + np.uint64(n)])).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
        at += n
    return sets


def prefix(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare before frequent, of which any set that links shares ``needed`` at least."""
    n = len(shingles)
    take = min(n, n - (-(-NUM * n // DEN)) + 1 + n // EXTRA)
    if not n or not len(frequent):
        return shingles[:take]
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    often = frequent[at] == shingles
    return np.concatenate((shingles[~often], shingles[often]))[:take]


def needed(n: int) -> int:
    """How many shingles of its prefix a set of ``n`` shares with any set that links.

    Of two prefixes, all shared shingles up to the earlier end are in both; that is a twelfth of the one set's size and
    one more, and that set has three quarters of the other's size at least.
    """
    return -(-NUM * n // DEN) // EXTRA + 1


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets link."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or DEN * len(a) < NUM * len(b):
        return False
    shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return DEN * shared >= NUM * (len(a) + len(b) - shared)


class SignatureTree:
    """Documents in order of size, in leaves and nodes; level 0 is the documents themselves."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray, bits: int):
        first = np.array([sets[i][0] for i in members])
        sizes = np.array([len(sets[i]) for i in members])
        self.members = members[np.lexsort((first, sizes))]
        bitmap = np.zeros((len(members), bits // 64), np.uint64)
        for row, i in enumerate(self.members):
            bit = (sets[i].view(np.uint64) >> np.uint64(8)) % np.uint64(bits)
            np.bitwise_or.at(bitmap[row], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        sizes = np.array([len(sets[i]) for i in self.members])
        extra = sizes - np.bitwise_count(bitmap).sum(axis=1)  # shingles beyond one for each set bit
        #: by level: OR of the bitmaps, least and greatest size, most extra shingles
        self.levels = [(bitmap, sizes, sizes, extra)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            b, low, high, x = self.levels[-1]
            at = np.arange(0, len(low), width)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(x, at)))
            width = FANOUT
        if len(self.levels) == 1:
            self.levels.append(self.levels[0])

    def children(self, level: int, node: int) -> slice:
        width = LEAF if level == 1 else FANOUT
        return slice(node * width, (node + 1) * width)


def possible(a: SignatureTree, la: int, sa: slice, b: SignatureTree, lb: int, sb: slice) -> np.ndarray:
    """Which pairs of nodes may hold documents that link, by greatest overlap and by sizes."""
    (bits_a, low_a, high_a, extra_a), (bits_b, low_b, high_b, extra_b) = ([x[s] for x in t.levels[k]] for t, k, s in ((a, la, sa), (b, lb, sb)))
    shared = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2).astype(np.int64)
    overlap = shared + np.minimum(extra_a[:, None], extra_b[None, :])
    enough = (NUM + DEN) * overlap >= NUM * (low_a[:, None] + low_b[None, :])
    return enough & (DEN * high_a[:, None] >= NUM * low_b[None, :]) & (DEN * high_b[None, :] >= NUM * low_a[:, None])


def tree_join(sets: list[np.ndarray], a: SignatureTree, b: SignatureTree, forest: Forest) -> None:
    """Joins in ``forest`` every two documents of the trees that link, unless they are joined already."""
    top_a, top_b = len(a.levels) - 1, len(b.levels) - 1
    stack = [(top_a, 0, top_b, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if a is b and la == lb and i > j:
            continue
        ca, cb = a.children(la, i), b.children(lb, j)
        if la > 1 or lb > 1:  # down the taller side, both if even
            na, sa = (la - 1, ca) if la >= lb else (la, slice(i, i + 1))
            nb, sb = (lb - 1, cb) if lb >= la else (lb, slice(j, j + 1))
            for x, y in zip(*np.nonzero(possible(a, na, sa, b, nb, sb)), strict=True):
                stack.append((na, sa.start + int(x), nb, sb.start + int(y)))
            continue
        for x, y in zip(*np.nonzero(possible(a, 0, ca, b, 0, cb)), strict=True):
            p, q = int(a.members[ca.start + x]), int(b.members[cb.start + y])
            if p != q and forest.find(p) != forest.find(q) and links(sets[p], sets[q]):
                forest.union(p, q)


def join_block(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """Links as edges to the smallest id of each tree; ``side``: documents meet the other side, or all if it is one."""
    order = np.argsort(ids, kind="stable")
    ids, sets, side = ids[order], [sets[i] for i in order], side[order]
    forest = Forest(len(ids))
    known: dict[bytes, int] = {}
    alone = []
    for i, s in enumerate(sets):  # equal sets are one document to the trees, on each side
        j = known.setdefault(hashlib.blake2b(s.tobytes() + bytes([side[i]]), digest_size=16).digest(), i)
        if j != i:
            forest.union(i, j)
        elif len(s):
            alone.append(i)
    alone = np.array(alone, np.int64)
    bits = 256
    while alone.size and bits < 8192 and bits < 2 * max(len(sets[i]) for i in alone):
        bits *= 2
    sides = [alone[side[alone] == k] for k in (0, 1)]
    trees = [SignatureTree(sets, m, bits) for m in sides if len(m)]
    if len(trees) == 1:
        if not side.any() or side.all():
            tree_join(sets, trees[0], trees[0], forest)
    elif trees:
        tree_join(sets, trees[0], trees[1], forest)
    return [(int(ids[i]), int(ids[forest.find(i)])) for i in range(len(ids)) if forest.find(i) != i]


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of at most ``FREQUENT_KEPT`` shingles, those in most documents among the locally frequent ones."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, size = [], 0, 0

        def often() -> pd.DataFrame:
            value, times = np.unique(np.concatenate(held), return_counts=True)
            some = times >= max(FREQUENT_LEAST, FREQUENT_SHARE * n)
            return pd.DataFrame({"h": value[some], "n": times[some]})

        for batch in batches:
            sets = shingle_sets(batch["text"].tolist())
            held, n, size = held + sets, n + len(sets), size + sum(map(len, sets))
            if size > CHUNK_SHINGLES:
                yield often()
                held, n, size = [], 0, 0
        if held:
            yield often()

    rows = docs.select("text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "h").limit(FREQUENT_KEPT).select("h").collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64))


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(id, rep, n, prefix): ``rep`` is the id of the first document with the same words in the task; prefix for it alone.

    A row with a null id has its own null as ``rep``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[bytes, int] = {}
        for batch in batches:
            sets, reps, heads = shingle_sets(batch["text"].tolist()), [], []
            for i, named, s in zip(batch["id"].tolist(), batch["named"], sets, strict=True):
                key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                fresh = named and len(s) and first.setdefault(key, i) == i
                reps.append(first[key] if named and len(s) else i)
                heads.append(prefix(s, shared.value) if fresh else None)
            yield pd.DataFrame({"id": batch["id"], "named": batch["named"], "rep": reps, "n": [len(s) for s in sets], "prefix": heads})

    # pandas has no whole numbers beside nulls
    filled = docs.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("named"), "text")
    made = filled.mapInPandas(read, "id long, named boolean, rep long, n long, prefix array<long>")
    return made.select(F.when(F.col("named"), F.col("id")).alias("id"), F.when(F.col("named"), F.col("rep")).alias("rep"), "n", "prefix")


def _gathered(batches: Iterator[pd.DataFrame], *columns: str) -> list[np.ndarray]:
    """The columns of a partition, in order of the first of them; only rows whose value there recurs."""
    read = [tuple(b[c].to_numpy() for c in columns) for b in batches]
    if not read:
        return []
    held = [np.concatenate(x) for x in zip(*read, strict=True)]
    order = np.argsort(held[0], kind="stable")
    held = [x[order] for x in held]
    same = held[0][1:] == held[0][:-1]
    some = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(order) else np.zeros(0, bool)
    return [x[some] for x in held]


def _alive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles that several documents of the partition hold, with their number."""
    if held := _gathered(batches, "h", "rep", "need"):
        h, rep, need = held
        starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        size = np.diff(starts, append=len(h))
        yield pd.DataFrame({"rep": rep, "h": h, "df": np.repeat(size, size).astype(np.int32), "need": need})


def _clustered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a: node, b: smallest node) of the clusters by shared shingles within a partition."""
    if held := _gathered(batches, "h", "top"):
        nodes, at = np.unique(held[1], return_inverse=True)
        forest = Forest(len(nodes))
        forest.join_runs(held[0], at)
        inner = forest.parent != np.arange(len(nodes))
        yield pd.DataFrame({"a": nodes[inner], "b": nodes[forest.parent[inner]]})


def _join(group: pd.DataFrame) -> pd.DataFrame:
    sets = [np.asarray(s, np.int64) for s in group["shingles"]]
    edges = join_block(group["rep"].to_numpy(), sets, group["side"].to_numpy().astype(np.int8))
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id.

    A null or blank text has an empty set and links with nothing; its component is its own id. Rows with a null id link
    with nothing and have a null component; rows that share an id are one document with the links of all of them.
    Documents of equal words are one class throughout. An empty table gives no rows; other columns are left out,
    whatever their names.
    """
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = saved(_prefixes(read, frequent_shingles(read)), "jaccard_rows")
    three_quarters = F.ceil(F.col("n") * NUM / DEN)
    alive = rows.select("rep", (F.floor(three_quarters / EXTRA) + 1).cast("int").alias("need"), F.explode("prefix").alias("h")).repartition(
        "h").mapInPandas(_alive, "rep long, h long, df int, need int")
    kept = alive.groupBy("rep").agg(F.first("need").alias("need"), F.array_sort(F.collect_list(F.struct("df", "h"))).alias("alive")).where(
        F.size("alive") >= F.col("need"))
    rare = saved(kept.select("rep", F.transform(F.slice("alive", F.lit(1), F.size("alive") - F.col("need") + 1), lambda x: x["h"]).alias("h")).select(
        "rep", F.element_at("h", -1).alias("top"), "h"), "jaccard_rare")
    # a document's most frequent shingle of these is its node; a group of near copies has few such
    nodes = rare.select("top", F.explode("h").alias("h")).where("h <> top").distinct().unionByName(rare.select("top", F.col("top").alias("h")).distinct())
    linked = connected_components(nodes.repartition("h").mapInPandas(_clustered, "a long, b long"), "jaccard_clusters")
    named = saved(rare.select(F.col("rep").alias("node"), "top").join(linked.withColumnRenamed("node", "_top"), F.col("top") == F.col("_top"), "left").select(
        "node", F.coalesce("component", "top").alias("component")), "jaccard_named")
    sizes = saved(named.groupBy("component").count().where("count > 1"), "jaccard_sizes")
    clusters = saved(named.join(sizes, "component", "left_semi"), "jaccard_cluster")

    # the sets of clustered documents alone
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = shingle_sets([unpack(t) for t in batch["text"]])
            yield pd.DataFrame({"rep": batch["id"], "cluster": batch["component"], "shingles": found, "size": [len(s) for s in found]})

    held = read.select("id", packed("text").alias("text")).join(clusters.hint("merge"), F.col("id") == F.col("node")).select("id", "text", "component").mapInPandas(
        sets, "rep long, cluster long, shingles array<long>, size long").where("size > 0")
    # a cluster beyond a block is cut by size class: documents that link are in one class or in neighbouring ones
    many = sizes.where(F.col("count") > block)
    wide = rows.join(clusters, F.col("rep") == F.col("node"), "left_semi").where("prefix is not null").select("rep", "n").join(
        clusters, F.col("rep") == F.col("node")).join(many, "component")
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(DEN / NUM))).cast("int")
    blocks = wide.groupBy(F.col("component").alias("_cluster"), step.alias("_class")).agg(
        F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    blocks = blocks.groupBy("_cluster").agg(F.map_from_entries(F.collect_list(F.struct("_class", "_blocks"))).alias("_blocks"))
    own_class = F.floor(F.log(F.col("size").cast("double")) / float(np.log(DEN / NUM))).cast("int")
    dealt = held.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(16)).cast("int")).join(
        saved(blocks, "jaccard_blocks").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15)))),
        (F.col("cluster") == F.col("_cluster")) & (F.col("salt") == F.col("_salt")), "left").withColumn("class", own_class)
    own_blocks = F.coalesce(F.col("_blocks")[F.col("class")], F.lit(1))
    dealt = dealt.withColumn("own", F.struct(F.col("class"), F.pmod(F.xxhash64("rep", F.lit(1)), own_blocks).cast("int").alias("block")))

    def others(step: int):
        c = F.col("class") + step
        n = F.coalesce(F.col("_blocks")[c], F.lit(0))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(c.alias("class"), i.alias("block"))))

    none = F.expr("cast(array() as array<struct<class:int,block:int>>)")
    every = F.when(F.col("_blocks").isNull(), F.array(F.lit(None).cast("struct<class:int,block:int>"))).otherwise(
        F.concat(*(F.coalesce(others(s), none) for s in (-1, 0, 1))))
    tasks = dealt.withColumn("other", F.explode(every)).select(
        "cluster", F.when(F.col("other").isNotNull(), F.least("own", "other")).alias("lo"),
        F.when(F.col("other").isNotNull(), F.greatest("own", "other")).alias("hi"),
        F.coalesce(F.col("own") > F.col("other"), F.lit(False)).alias("side"), "rep", "shingles")
    found = tasks.groupBy("cluster", "lo", "hi").applyInPandas(_join, "a long, b long")
    parts = saved(connected_components(found, "jaccard_links"), "jaccard_parts")

    # every row by its class, then the smallest id of each component; plain reads, so that Spark can split a hot key
    grouped = saved(rows.join(parts, rows["rep"] == parts["node"], "left").select(
        "id", "n", F.coalesce("component", "rep").alias("root")), "jaccard_grouped")
    least = saved(grouped.where("root is not null").groupBy(F.col("root").alias("_root")).agg(F.min("id").alias("least")), "jaccard_least")
    return grouped.join(least, grouped["root"] == least["_root"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group kept, that of the smallest id; all columns stay, as do rows without links."""
    found = near_duplicates(docs, id_col, text_col)
    gone = saved(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct(), "jaccard_gone")
    light = docs.withColumn(text_col, packed(text_col))
    return light.join(gone.hint("merge"), light[id_col] == gone["_gone"], "left_anti").withColumn(text_col, unpacked(text_col))
