"""Operator 6: embedding near-duplicates by spherical k-means cells and blocked cosine products.

Spherical k-means (fitted on a bounded sample) gives every vector a home cell, that of the nearest centre. Vectors are
compared within cells. So that no link is lost at a border, a vector is also a guest of each cell of a lower number whose
border it is near to: if x and y link and y's home is c, then x lies no further than the link's angle beyond the plane
between c and x's own centre. A pair thus meets exactly once, in the lower of its home cells. A cell's vectors are dealt
into blocks, pairs of blocks are tasks of bounded size, and a task returns each vector's number of links and a spanning
forest of them rather than all pairs. Equal vectors are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import saved
from orderflow.llm.components import connected_components

THRESHOLD = 0.93
#: The k-means is fitted on at most so many vectors; the number of cells is the cheapest of these by the sample (``choose_cells``).
SAMPLE, CELLS = 8192, (4, 16, 64, 256, 1024)
#: Comparing so many pairs costs as much as moving one vector.
PAIRS_A_MOVE = 20_000
K_MEANS_ROUNDS = 15
#: Vectors of a block; a task compares two blocks, so many rows at a time.
BLOCK, ROWS_AT_ONCE = 2000, 500
_SLACK = 1e-9


def unit_rows(vectors: list) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = np.array([np.asarray(v, np.float64) for v in vectors], np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_k_means(x: np.ndarray, k: int, rounds: int = K_MEANS_ROUNDS) -> np.ndarray:
    """Unit centres; the first is a row of ``x``, each further one the row least like those before (farthest first)."""
    k = min(k, len(x))
    centres, like = [x[0]], x @ x[0]
    for _ in range(k - 1):
        i = int(like.argmin())
        centres.append(x[i])
        like = np.maximum(like, x @ x[i])
    c = np.array(centres)
    for _ in range(rounds):
        home = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def cells_of(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each row, and the lower cells that it is a guest of."""
    like = x @ centres.T
    home = like.argmax(axis=1)
    far = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T)))
    reach = np.sqrt(max(0.0, 1 - threshold * threshold)) + _SLACK
    own = like[np.arange(len(x)), home]
    near = (own[:, None] - like) <= reach * far[home]
    near &= np.arange(len(centres))[None, :] < home[:, None]
    return home, [np.flatnonzero(r) for r in near]


def choose_cells(x: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Centres of the cheapest number of cells for ``n`` vectors of a label that are spread as the sample ``x``.

    More cells compare fewer pairs and move more guests. Where vectors lie in clusters guests are few and cells small; vectors
    that are spread evenly in many dimensions are near to every border, and the fewest cells are the cheapest."""
    best, least = np.ones((1, x.shape[1])), np.inf
    for k in CELLS:
        centres = spherical_k_means(x, k)
        home, guests = cells_of(x, centres, threshold)
        share = np.bincount(home, minlength=len(centres)) / len(x)
        visits = np.bincount(np.concatenate([*guests, np.zeros(0, np.int64)]).astype(np.int64), minlength=len(centres)) / len(x)
        cost = n * (share * (share / 2 + visits)).sum() + PAIRS_A_MOVE * (1 + visits.sum())
        if cost >= least:
            break
        best, least = centres, cost
    return best


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric link matrix, by breadth."""
    left = links.any(axis=1)
    edges = []
    while left.any():
        frontier = np.array([int(left.argmax())])
        left[frontier] = False
        while len(frontier):
            hit = links[frontier] & left
            new = np.flatnonzero(hit.any(axis=0))
            edges += zip(new.tolist(), frontier[hit[:, new].argmax(axis=0)].tolist(), strict=True)
            left[new] = False
            frontier = new
    return edges


def link_matrix(x: np.ndarray, guest: np.ndarray, side: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows link: across sides, or within if there is one; guests don't meet guests."""
    n = len(x)
    links = np.zeros((n, n), bool)
    one = side.all() or not side.any()
    for i in range(0, n, ROWS_AT_ONCE):
        rows = slice(i, i + ROWS_AT_ONCE)
        near = x[rows] @ x.T >= threshold
        links[rows] = near & ~(guest[rows, None] & guest[None, :]) & (one | (side[rows, None] != side[None, :]))
    np.fill_diagonal(links, False)
    return links


_TASK_OUT = "a long, b long, links long"


def _compare(threshold: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        if (group["lo"].iloc[0] != group["hi"].iloc[0]) and group["side"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": [], "links": []}).astype({"a": "int64", "b": "Int64", "links": "int64"})
        ids, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        found = link_matrix(unit_rows(group["vec"].tolist()), group["guest"].to_numpy(), group["side"].to_numpy(), threshold)
        some = np.flatnonzero(found.any(axis=1))
        found, ids, copies = found[np.ix_(some, some)], ids[some], copies[some]
        edges = _forest(found)
        links = np.array([copies[row].sum() for row in found], np.int64)
        return pd.concat([pd.DataFrame({"a": ids, "b": None, "links": links}),
                          pd.DataFrame({"a": ids[[a for a, _ in edges]], "b": ids[[b for _, b in edges]], "links": 0})]).astype(
            {"a": "int64", "b": "Int64", "links": "int64"})
    return compare


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row for each vector: id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine is at least ``threshold``. A vector that is
    null, empty, zero or holds null or non-finite components, or has no label, links with nothing, as do vectors of
    different lengths. ``component_id`` is the smallest id reachable by links; rows with a null id link with nothing.
    A row that recurs with id, label and vector counts as one vector and is returned as often as it is there; other columns are
    left out, whatever their names.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
            & F.coalesce(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists("vec", lambda v: v != 0), F.lit(False)))
    # a vector is named by 128 bits; vectors themselves are moved once
    rows = saved(rows.withColumns({"good": good, "d1": F.xxhash64("vec"), "d2": F.xxhash64(F.lit(1), "vec")}), "vectors")
    named = ["label", "d1", "d2"]
    copies = rows.where("good").select("id", *named).distinct().groupBy(*named).agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = saved(rows.where("good").groupBy(*named).agg(F.first("vec").alias("vec")).join(copies.hint("merge"), named), "vector_classes")

    sizes = classes.groupBy("label", F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size", "label").limit(1).collect()
    width, n = (sizes[0]["size"], sizes[0]["count"]) if sizes else (1, 0)
    sample = classes.where(F.size("vec") == width).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vec").collect()
    centres = choose_cells(unit_rows([r["vec"] for r in sample]), n, threshold) if sample else np.ones((1, 1))
    shared = classes.sparkSession.sparkContext.broadcast(centres)  # at most CELLS[-1] rows

    out = T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = [[-1]] * len(batch)  # vectors of other lengths: one cell for each length
            at = np.flatnonzero([len(v) == shared.value.shape[1] for v in batch["vec"]])
            if len(at):
                homes, guests = cells_of(unit_rows([batch["vec"].iloc[i] for i in at]), shared.value, threshold)
                for i, h, g in zip(at, homes.tolist(), guests, strict=True):
                    cells[i] = [h, *g.tolist()]
            yield batch.assign(cells=cells)

    dealt = saved(classes.mapInPandas(deal, out), "vector_cells").select(
        "label", F.size("vec").alias("size"), "rep", "copies", "vec", F.posexplode("cells").alias("guest", "cell")).withColumn(
        "guest", F.col("guest") > 0)
    key = ["label", "size", "cell"]
    counted = dealt.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).select(
        *(F.col(k).alias(f"_{k}") for k in key), "blocks")
    # the join's rows are dealt by salt as well: a cell may hold a third of all rows
    salts = 32
    salted = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    numbered = dealt.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    on = [numbered[k] == salted[f"_{k}"] for k in key] + [numbered["salt"] == salted["_salt"]]
    blocks = numbered.join(salted, on).withColumn("own", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int"))
    tasks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).alias("side"), "guest", "rep", "copies", "vec")
    found = saved(tasks.groupBy(*key, "lo", "hi").applyInPandas(_compare(threshold), _TASK_OUT), "vector_links")

    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("b is not null").select("a", "b"), "vector_components")
    described = saved(classes.drop("vec").join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("_label"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "rep",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component")), "vector_results")
    # a class may hold a third of all rows; both sides are plain reads, so that Spark can split a hot key here
    joined = rows.drop("vec").join(described, F.col("good") & (F.col("label") == F.col("_label")) & (F.col("d1") == F.col("_d1"))
                                   & (F.col("d2") == F.col("_d2")), "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def representatives(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """``vectors`` with one row of each group kept; all columns stay."""
    kept = near_duplicates(vectors, id_col=id_col, **options).where("kept").select(F.col(id_col).alias("_kept")).distinct()
    return vectors.join(kept, vectors[id_col].eqNullSafe(kept["_kept"]), "left_semi")
