"""Connected components of a distributed edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved

#: Into how many parts the edges of one node are dealt in a join, so that a hub isn't one task.
SALTS = 32


def _with_least(edges: DataFrame, least: DataFrame, node: str) -> DataFrame:
    """``edges`` with the column ``m`` of ``least`` (n, m) for their end ``node``; a hub's edges are dealt by salt."""
    dealt = edges.withColumn("_s", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int"))
    # grows with the data, and more than Spark's size check knows: never broadcast
    salted = least.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return dealt.join(salted, (dealt[node] == salted["n"]) & (dealt["_s"] == salted["_t"])).drop("_s", "_t", "n")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the component is its smallest node.

    An edge has the greater end in ``a`` from then on. In a round every node's greater neighbours are linked to its
    smallest neighbour, then every node's smaller neighbours to the smallest of them, until all edges are stars. Only
    minima are gathered by node, so a hub's edges are combined before the shuffle. Self-links give a component of
    one; null ends are left out.
    """
    links = edges.where("a is not null and b is not null").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = saved(links, name)
    alone = links.where("a = b")
    now, before = links.where("a <> b"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        least = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(
            F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = saved(_with_least(now, least, "b").select("a", F.col("m").alias("b")).distinct(), name)
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = _with_least(large, low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = saved(small.unionByName(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), name)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).unionByName(
        alone.select(F.col("b").alias("node"), F.col("b").alias("component")))
    return stars.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


class Forest:
    """Union-find over positions 0 to n - 1; the smallest position of a tree is its root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def union(self, i: int, j: int) -> bool:
        """Joins two trees; False if they were one."""
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True

    def join_runs(self, keys: np.ndarray, nodes: np.ndarray) -> None:
        """Joins all nodes that share a key, with as many passes as labels take to settle (numpy only)."""
        if not len(nodes):
            return
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(starts, append=len(keys))
        while True:
            label = self.parent[nodes]
            low = np.repeat(np.minimum.reduceat(label, starts), size)
            after = self.parent.copy()
            np.minimum.at(after, label, low)
            np.minimum.at(after, nodes, low)
            while True:
                jumped = after[after]
                if (jumped == after).all():
                    break
                after = jumped
            if (after == self.parent).all():
                return
            self.parent = after
