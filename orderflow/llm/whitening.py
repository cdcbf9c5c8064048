"""Operator 12: whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers, so that sums are exact and rows are centred without cancellation however far the mean lies
from zero. With Y the centred rows (n x d), every pass over the data is one distributed Gram matrix:

1. G = Y'Y; R1 is the Cholesky factor of G + sI, with the small shift s that makes it exist for any Y;
2. tasks solve Q R1 = Y by rows (a triangular solve) and give Q'Q, whose factor is R2, and so on, until Q'Q is the identity,
   or a projection where Y has less than full rank;
3. the factors compose to R, with Y = Q R and Q orthonormal; R is d x d, and its singular values and right vectors are those
   of Y: components, and deviations along them.

The condition of Y isn't squared, as it would be by the eigenvectors of Y'Y alone. A task holds one batch of rows and two
matrices of d x d; the driver gets d sums and d x d sums a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import by_row

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond this size count as this large: their sums stay whole numbers of 64 bits in a task.
LARGEST = 1 << 40
#: Q'Q is near enough to the identity; directions below ``NULL`` of the largest deviation have none.
NEAR, NULL = 1e-12, 1e-9
PASSES = 8


@dataclass
class Whitening:
    """What a fit found; ``components`` are columns, by falling eigenvalue of the covariance."""

    n: int
    dim: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0
    passes: int = 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, *self.mean())

    def mean(self) -> tuple[np.ndarray, np.ndarray, int]:
        """The whole part of the mean, what is left of the sums beyond it, and n."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - w * self.n for s, w in zip(self.sums, whole, strict=True)], np.int64), self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 by row; None where it has more than 64 bits."""
        whole, rest, n = self.mean()
        u = x - whole
        if n * (int(np.abs(u).max(initial=0)) + 1) < 2**62 // max(1, self.dim) and self.dim * (n * (int(np.abs(u).max(initial=0)) + 1)) ** 2 < 2**63:
            return ((n * u - rest) ** 2).sum(axis=1).tolist()
        exact = ((n * u.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    return (x - whole).astype(float) - rest / n


def solve_rows(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Q of Q R = Y, R the product of upper triangular ``factors`` (the first is the rightmost), row by row of Y."""
    for r in factors:
        q = np.empty_like(y)
        for j in range(len(r)):
            q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        y = q
    return y


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int, whole: bool = False) -> list:
    """Sums of ``part(x)`` (``size`` numbers for a batch of vectors) over all vectors; added by task, then by place."""
    kind = "long" if whole else "double"

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, any_rows = np.zeros(size, np.int64 if whole else float), False
        for batch in batches:
            if len(batch):
                total, any_rows = total + part(np.stack(batch["x"].to_numpy())), True
                if whole and np.abs(total).max(initial=0) > 2**61:
                    yield pd.DataFrame({"part": [total]})
                    total, any_rows = np.zeros(size, np.int64), False
        if any_rows:
            yield pd.DataFrame({"part": [total]})

    placed = rows.select("x").mapInPandas(add, f"part array<{kind}>").select(F.posexplode("part").alias("place", "value"))
    total = F.sum(F.col("value").cast("decimal(38,0)") if whole else F.col("value"))
    found = {r["place"]: r["total"] for r in placed.groupBy("place").agg(total.alias("total")).collect()}  # size rows
    return [found[i] for i in range(size)] if found else [0] * size


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): vectors without null or non-finite entries, of the length that most of them have, in whole numbers."""
    entry = F.col(vec_col)
    sound = vectors.where(entry.isNotNull() & (F.size(entry) > 0) & F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))))
    most = sound.groupBy(F.size(entry).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()

    def whole(c):
        scaled = F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        return F.floor(scaled).cast("long") + OFFSET

    return sound.where(F.size(entry) == (most["d"] if most else 0)).select(
        F.col(id_col), F.transform(entry, whole).alias("x")).withColumnRenamed(id_col, "id")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (x: array of whole numbers of one length); None without rows."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    found = summed(rows, lambda x: np.append(x.sum(axis=0), len(x)), d + 1, whole=True)
    sums, n = [int(s) for s in found[:d]], int(found[d])
    model = Whitening(n, d, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    mean = model.mean()
    upper = np.triu_indices(d)

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            q = solve_rows(_centred(x, *mean), factors)
            return (q.T @ q)[upper]

        g = np.zeros((d, d))
        g[upper] = summed(rows, part, len(upper[0]))
        return g + np.triu(g, 1).T

    g = gram([])
    model.trace = float(np.trace(g)) / n
    if not model.trace > 0:
        return model
    unit = float(np.finfo(float).eps) / 2
    factors: list[np.ndarray] = []
    for _ in range(PASSES):
        weights, vectors = np.linalg.eigh(g)
        if factors and np.all((np.abs(weights - 1) < NEAR * d) | (weights < NULL)):
            break
        shift = 0.0 if factors else min(1e-3, 11 * d * (n + d + 1) * unit) * float(np.linalg.norm(g, 2))
        try:
            r = np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:  # less than full rank
            r = np.linalg.cholesky(g + 1e-8 * max(1.0, float(weights[-1])) * np.eye(d)).T
        factors.append(r)
        g = gram(factors)
    # what is left of the last Gram matrix is the last factor; it may be singular
    weights, vectors = np.linalg.eigh(g)
    composed = np.sqrt(np.maximum(weights, 0))[:, None] * vectors.T
    for r in reversed(factors):
        composed = composed @ r
    _, sigma, right = np.linalg.svd(composed)
    kept = min(components, int((sigma > NULL * sigma[0]).sum()))
    model.components, model.eigenvalues, model.passes = right[:kept].T, sigma[:kept] ** 2 / n, len(factors) + 1
    model.identity_error = _identity_error(rows, model)
    return model


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured on all of them."""
    mean, k = model.mean(), model.components.shape[1]
    axes = model.components / np.sqrt(model.eigenvalues)

    def part(x: np.ndarray) -> np.ndarray:
        w = _centred(x, *mean) @ axes
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    found = np.array(summed(rows, part, k + k * k)) / model.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0))


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened: array of one number a component) of ``rows`` (id, x)."""
    axes = model.components / np.sqrt(model.eigenvalues)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, model.dim), np.int64)
            yield pd.DataFrame({"id": batch["id"], "deviation": pd.Series(model.deviation(x), dtype=object),
                                "whitened": list(model.centred(x) @ axes)})

    return by_row(rows, project, "id", "deviation long, whitened array<double>", x="x")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each sound vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Dropped are null and empty vectors, those with null or non-finite entries, and those of another length than most (of
    equally common lengths the greater counts). Repeated rows count each; a null id stays null. Components without
    deviation are left out, so equal vectors, one vector or an empty table give no rows. Of equal eigenvalues any basis may
    come out. Entries beyond 2^40 / 64 count as that large; a deviation of more than 64 bits is null. Other columns are left
    out, whatever their names.
    """
    rows = whole_vectors(vectors, id_col, vec_col)
    model = fit(rows, components)
    if model is None or not len(model.eigenvalues):
        model = Whitening(1, 1, [0], np.zeros((1, 0)), np.zeros(0), 1.0)
        rows = rows.where("false")
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues), F.lit(0.0))
    return transform(rows, model).select("id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
