"""Operator 1: toxicity by cumulative-link ordinal regression over sparse text features.

Severity grades are ordered: 0 clean, then toxic ones. One weight vector is shared by all thresholds:
P(grade >= k) = sigmoid(w.x - threshold_k), thresholds rising. Features are words and word beginnings that labelled toxic
documents hold far more often than clean ones, chosen one by one for the toxic documents that the ones before explain too
little; a document's value of a feature is log(1 + count). Labels say toxic or not; toxic documents are graded by how many
words such features mark, split at the median, and weights aren't negative: more marked words never lower the severity. The output is the expected severity, the sum of
P(grade >= k).

The model is fitted on at most ``max_labelled`` labelled documents, the first by a hash of the id. Scoring reads whole texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import by_row, saved
from orderflow.llm.decontaminate import words_of
from orderflow.llm.jaccard_join import shingle_sets

#: Bounds of the fit: labelled documents, features to choose from, and features with a weight. A feature is chosen only if it
#: serves a hundredth of the toxic documents that still lack some, so far fewer than ``MAX_FEATURES`` are (some 60 on the test tables).
MAX_LABELLED = 20_000
MAX_CANDIDATES, MAX_FEATURES = 4096, 512
#: Word beginnings that are features too, in characters; they carry a stem to endings no labelled document has.
STEMS = (3, 4, 5, 6)
#: A feature is in at least so many toxic documents, and so many times as common there.
MIN_TOXIC, MIN_RATIO = 4, 10.0
#: A toxic document is explained by so many features; a further feature must serve this share of toxic documents.
EXPLAINED_BY, MIN_SHARE = 12, 0.01
#: Documents of this expected severity and more are toxic.
MIN_SEVERITY = 0.5
ROUNDS, RIDGE = 1500, 1e-5
#: Words that a worker keeps in memory with what they add.
MAX_SEEN = 500_000


def features(text: str | None) -> dict[str, int]:
    """Counts by word, and by beginning of a longer word (marked by a star)."""
    found: Counter = Counter()
    for raw, n in Counter(words_of((text or "").lower())).items():
        word = raw.decode("utf-8", "replace")
        found[word] += n
        for k in STEMS:
            if len(word) > k:
                found[word[:k] + "*"] += n
    return found


@dataclass
class OrdinalModel:
    """Weights shared by all thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    _seen: dict[bytes, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def linear(self, counts: dict[str, int]) -> float:
        get = self.weights.get
        return sum(w * np.log1p(n) for f, n in counts.items() if (w := get(f)))

    def counts(self, text: str | None) -> dict[str, int]:
        """``features`` of a text, those with a weight alone. What a word adds is looked up once for each worker."""
        found: dict[str, int] = {}
        seen, weights = self._seen, self.weights
        for raw, n in Counter(words_of((text or "").lower())).items():
            own = seen.get(raw)
            if own is None:
                word = raw.decode("utf-8", "replace")
                own = tuple(f for f in (word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)) if f in weights)
                if len(seen) >= MAX_SEEN:
                    seen.clear()
                seen[raw] = own
            for f in own:
                found[f] = found.get(f, 0) + n
        return found

    def at_least(self, linear: float) -> list[float]:
        """P(grade >= k) for k from 1."""
        return [float(1 / (1 + np.exp(min(700.0, t - linear)))) for t in self.thresholds]


def fit_ordinal(x: list[dict[int, float]], grades: np.ndarray, width: int, rounds: int = ROUNDS,
                ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds by gradient steps (Adam) on the penalised log-likelihood; no weight is negative."""
    n, levels = len(grades), int(grades.max(initial=0))
    row = np.repeat(np.arange(n), [len(r) for r in x])
    col = np.fromiter((c for r in x for c in r), np.int64, len(row))
    value = np.fromiter((v for r in x for v in r.values()), float, len(row))
    p = np.concatenate((np.zeros(width), [1.0], np.zeros(levels - 1)))  # weights, first threshold, log gaps
    m, s = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        w, gaps = p[:width], np.exp(p[width + 1:])
        limits = np.concatenate(([-np.inf], p[width] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        z = np.bincount(row, value * w[col], minlength=n)
        with np.errstate(over="ignore"):
            above, below = 1 / (1 + np.exp(z - limits[grades + 1])), 1 / (1 + np.exp(z - limits[grades]))
        mass = np.maximum(above - below, 1e-12)
        da, db = above * (1 - above) / mass, below * (1 - below) / mass
        dz = (da - db) / n  # minus log-likelihood by z
        dl = np.bincount(grades + 1, -da / n, minlength=levels + 2) + np.bincount(grades, db / n, minlength=levels + 2)
        dl = dl[1:levels + 1]
        grad = np.concatenate((np.bincount(col, dz[row] * value, minlength=width) + ridge * w,
                               [dl.sum()], [dl[k + 1:].sum() * g for k, g in enumerate(gaps)]))
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-9)
        p[:width] = np.maximum(p[:width], 0)
    return p[:width], p[width] + np.concatenate(([0.0], np.cumsum(np.exp(p[width + 1:]))))


def choose(held: list[set[int]], n: int, least: int) -> list[int]:
    """Features, each the one that most documents of ``held`` still need; a document needs ``EXPLAINED_BY``."""
    need = np.full(len(held), EXPLAINED_BY)
    by: list[list[int]] = [[] for _ in range(n)]
    for d, fs in enumerate(held):
        for f in fs:
            by[f].append(d)
    docs = [np.array(d, np.int64) for d in by]
    chosen: list[int] = []
    left = set({tuple(d): f for f, d in reversed(list(enumerate(by)))}.values())  # of those in the same documents the longest
    while left and len(chosen) < MAX_FEATURES:
        gain, f = max(((int((need[docs[f]] > 0).sum()), -f) for f in left))
        if gain < least:
            break
        chosen.append(-f)
        left.discard(-f)
        need[docs[-f]] -= 1
        left = {f for f in left if len(docs[f]) >= least}
    return chosen


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """The model of at most ``max_labelled`` labelled documents; documents of the same set of shingles count once, with the
    text and label of the one of the smallest id.

    Null labels and texts are left out. Without toxic or without clean examples, or without a feature that tells them
    apart, the model has no thresholds and every severity is 0.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull()).select(
        F.col(label_id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic")).orderBy(
        F.xxhash64("id"), "id", F.desc("toxic")).limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).where("text is not null")
    # at most max_labelled ids and flags
    sample = texts.join(F.broadcast(chosen), F.col("_id") == F.col("id")).select("id", "text", "toxic")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # texts of the same shingles count once
            yield batch.assign(key=[hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in shingle_sets(batch["text"].tolist())])

    # of each such text one row, with its own label
    row = F.struct(F.col("id").alias("_id"), "toxic", "text")
    sample = sample.mapInPandas(keyed, T.StructType([*sample.schema.fields, T.StructField("key", T.StringType())])).groupBy("key").agg(
        F.min(row).alias("row")).select("row.text", "row.toxic")
    sample = saved(sample.select("text", "toxic"), "toxicity_sample")
    seen = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = seen.get(0, 0), seen.get(1, 0)
    if not n0 or not n1:
        return OrdinalModel()

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found.update((f, toxic) for f in features(text))
            yield pd.DataFrame([(f, t, n) for (f, t), n in found.items()], columns=["feature", "toxic", "n"])

    ratio = (F.col("n1") / n1) / ((F.col("n0") + 0.5) / n0)
    ranked = sample.mapInPandas(held, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0")).where(
        (F.col("n1") >= min(MIN_TOXIC, n1)) & (ratio >= MIN_RATIO)).orderBy(
        F.desc("n1"), F.desc(F.length("feature")), "feature").limit(MAX_CANDIDATES).collect()
    place = {r["feature"]: i for i, r in enumerate(ranked)}
    if not place:
        return OrdinalModel()

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = {place[f]: n for f, n in features(text).items() if f in place}
                rows.append((list(found), list(found.values())))
            yield pd.DataFrame(rows, columns=["at", "n"]).assign(toxic=batch["toxic"].to_numpy())

    rows = sample.mapInPandas(hits, "at array<int>, n array<int>, toxic int").collect()  # at most max_labelled
    picked = choose([set(r["at"]) for r in rows if r["toxic"]], len(place), max(min(MIN_TOXIC, n1), round(MIN_SHARE * n1)))
    if not picked:
        return OrdinalModel()
    at = {f: i for i, f in enumerate(picked)}
    counts = [{at[i]: n for i, n in zip(r["at"], r["n"], strict=True) if i in at} for r in rows]
    x = [{i: float(np.log1p(n)) for i, n in c.items()} for c in counts]
    toxic = np.array([r["toxic"] for r in rows])
    marks = np.array([sum(c.values()) for c in counts])
    marked = marks[(toxic > 0) & (marks > 0)]
    grades = np.where(toxic > 0, 1 + (marks > (np.median(marked) if len(marked) else 0)), 0)
    weights, thresholds = fit_ordinal(x, grades, len(at))
    return OrdinalModel({ranked[f]["feature"]: float(weights[i]) for f, i in at.items()}, tuple(map(float, thresholds)))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
          min_severity: float = MIN_SEVERITY) -> DataFrame:
    """One row for each row of ``docs``: id, severity (expected grade), grade (the likeliest), toxic.

    A null or empty text has no feature and scores as such. Of equally likely grades the lower counts. Repeated rows
    are scored each; an empty table gives no rows; other columns are left out, whatever their names.
    """
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                least = model.at_least(model.linear(model.counts(text)))
                exact = [a - b for a, b in zip([1.0, *least], [*least, 0.0], strict=True)]
                severity = round(sum(least), 6)
                rows.append((severity, int(np.argmax(exact)), severity >= min_severity))
            made = pd.DataFrame(rows, columns=["severity", "grade", "toxic"])
            made.insert(0, "id", batch["id"])
            yield made

    return by_row(docs, judge, id_col, "severity double, grade int, toxic boolean", text=text_col)


def reject_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text", min_severity: float = MIN_SEVERITY) -> DataFrame:
    """``docs`` without toxic rows; all columns stay, a null text too."""
    def severity(texts: pd.Series) -> pd.Series:
        return pd.Series([sum(model.at_least(model.linear(model.counts(t)))) for t in texts], dtype=float)

    severity.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.where(F.pandas_udf(severity, T.DoubleType())(F.col(text_col)) < min_severity)
