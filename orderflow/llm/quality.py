"""Operator 13: document quality by supervised subword embeddings.

A document's features are its words, the character n-grams of each word within its bounds (``<`` and ``>``), pairs of
neighbouring words, where a word that recurs at once is written as a reference back, and one end mark. Each feature is hashed
to one of ``BUCKETS`` learned vectors; their average over the document goes through a softmax over the labels.

Vectors and output weights are learned together by stochastic gradient descent in numpy, one document a step, on at most
``max_labelled`` labelled documents, the first by a hash of the id: tasks hold a shard of the sample each and run an epoch from
the present model, the results are averaged, and so on for ``EPOCHS`` rounds. The end mark gives an empty text a score of its
own. The average and the output are linear up to the last step, so scoring looks up one number a feature, the product of its
vector with the difference of the two labels' output weights; a word's features are summed once a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import by_row, mix64, saved

#: Bounds of the fit: labelled documents; buckets and entries of a vector.
MAX_LABELLED = 6_000
BUCKETS, DIM = 1 << 17, 8
#: Characters of the n-grams.
GRAMS = (2, 3, 4)
EPOCHS, SHARDS, RATE = 5, 8, 0.5
#: A score of so much and more predicts label 1.
MIN_SCORE = 0.3
#: Labels whose id has the checksum 0 modulo this are held out.
HELD_OUT = 5

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_END, _AGAIN = np.uint64(1), np.uint64(2)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix64(h) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Features:
    """Features of a batch of texts: buckets of each distinct word, and the words and pairs of each text."""

    n: int
    codes: np.ndarray  # the words of all texts, by distinct word
    owner: np.ndarray  # the text of each
    gram: np.ndarray  # buckets of the distinct words' own features
    gram_word: np.ndarray
    pair: np.ndarray  # buckets of pairs
    pair_owner: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Features:
        words = [(t or "").split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [w for ws in words for w in ws]
        codes, distinct = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), np.zeros(0, object))
        owner = np.repeat(np.arange(len(texts)), sizes)
        names = np.empty(len(distinct), object)
        names[:] = [w.encode("utf-8", "surrogatepass") for w in distinct]
        whole = mix64(pd.util.hash_array(names, categorize=False)) if len(names) else np.zeros(0, np.uint64)
        buckets, of_word = [_bucket(whole)], [np.arange(len(distinct))]
        letters = np.frombuffer("".join(f"<{w}>" for w in distinct).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        length = np.array([len(w) + 2 for w in distinct], np.int64)
        word = np.repeat(np.arange(len(distinct)), length)
        left = np.repeat(np.cumsum(length), length) - np.arange(len(letters))
        for n in GRAMS:
            at = np.flatnonzero(left >= n)
            h = np.full(len(at), n, np.uint64)
            for j in range(n):
                h = h * _M[0] + letters[at + j] * _M[1 + j % 3]
            buckets.append(_bucket(h))
            of_word.append(word[at])
        same = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
        first, second = codes[:-1][same], codes[1:][same]
        pair = np.where(first == second, _AGAIN, whole[first] * _M[2] + whole[second] * _M[3])
        return cls(len(texts), codes, owner, np.concatenate(buckets), np.concatenate(of_word), _bucket(pair), owner[1:][same])

    def average(self, weight: np.ndarray) -> np.ndarray:
        """Mean ``weight`` (one number a bucket) over the features of each text."""
        words = int(self.codes.max(initial=-1)) + 1
        by_word = np.bincount(self.gram_word, weight[self.gram], words)
        count = np.bincount(self.gram_word, minlength=words)
        total = np.bincount(self.owner, by_word[self.codes], self.n) + np.bincount(self.pair_owner, weight[self.pair], self.n)
        number = np.bincount(self.owner, count[self.codes], self.n) + np.bincount(self.pair_owner, minlength=self.n)
        return (total + weight[_bucket(np.array([_END]))[0]]) / (number + 1)

    def shares(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its buckets and what share of its features each of them has."""
        order = np.argsort(self.gram_word, kind="stable")
        gram, start = self.gram[order], np.searchsorted(self.gram_word[order], np.arange(int(self.codes.max(initial=-1)) + 2))
        words = np.searchsorted(self.owner, np.arange(self.n + 1))
        pairs = np.searchsorted(self.pair_owner, np.arange(self.n + 1))
        out = []
        for i in range(self.n):
            code, times = np.unique(self.codes[words[i]:words[i + 1]], return_counts=True)
            size = start[code + 1] - start[code]
            at = np.repeat(start[code] - np.concatenate(([0], np.cumsum(size)[:-1])) if len(code) else code, size) + np.arange(size.sum())
            own = np.concatenate((gram[at], self.pair[pairs[i]:pairs[i + 1]], _bucket(np.array([_END]))))
            weight = np.concatenate((np.repeat(times, size), np.ones(len(own) - len(at), np.int64)))
            buckets, place = np.unique(own, return_inverse=True)
            count = np.bincount(place, weight)
            out.append((buckets, count / count.sum()))
        return out


@dataclass
class QualityModel:
    """Vectors of the buckets and output weights of the two labels."""

    vectors: np.ndarray
    output: np.ndarray

    def weight(self) -> np.ndarray:
        """What a feature of each bucket adds to the log odds of label 1."""
        return self.vectors @ (self.output[1] - self.output[0])


def new_model() -> QualityModel:
    """Vectors of zero, so that a feature no labelled document has says nothing, and output weights that differ."""
    output = np.random.default_rng(13).normal(size=(2, DIM)) / np.sqrt(DIM)
    return QualityModel(np.zeros((BUCKETS, DIM)), output)


def epoch(model: QualityModel, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rate: float, seed: int) -> QualityModel:
    """One pass of stochastic gradient descent over ``rows`` (buckets, shares) in an order that ``seed`` sets."""
    vectors, output = model.vectors.copy(), model.output.copy()
    for i in np.random.default_rng(seed).permutation(len(rows)):
        buckets, share = rows[i]
        mean = share @ vectors[buckets]
        z = output @ mean
        p = np.exp(z - z.max())
        slope = p / p.sum()
        slope[int(labels[i])] -= 1
        # a step for the shares' own scale: many features with small shares each move as much as few with large ones
        vectors[buckets] -= rate / float(share @ share) * share[:, None] * (slope @ output)
        output -= rate * slope[:, None] * mean
    return QualityModel(vectors, output)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "quality", held_out: int = HELD_OUT, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """The model of at most ``max_labelled`` labelled documents whose checksum is not 0 modulo ``held_out``.

    Null ids and labels are left out; of several labels of an id the more frequent counts (1 if even). Null texts are
    empty; of rows with one id the least text counts. Without any label the model is that of no training: every score is one half.
    """
    ids = F.crc32(F.col(label_id_col).cast("string").cast("binary")) % held_out
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull() & (ids != 0)).groupBy(
        F.col(label_id_col).alias("id")).agg((F.avg(F.when(F.col(label_col) > 0, 1).otherwise(0)) >= 0.5).cast("int").alias("label")).orderBy(
        F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most max_labelled ids and labels; of rows with one id, one text
    sample = texts.join(F.broadcast(chosen), F.col("_id") == F.col("id")).groupBy("id").agg(
        F.min("text").alias("text"), F.min("label").alias("label")).select(F.xxhash64("id").alias("place"), "text", "label")

    shards = saved(_shards(sample), "quality_sample")
    model = new_model()
    for step in range(EPOCHS):
        model = _round(shards, model, RATE * (1 - step / EPOCHS), step)
    return model


def _shards(sample: DataFrame) -> DataFrame:
    """A row for each shard of ``sample`` (place, text, label): the labels, buckets and shares of its documents, at most
    ``MAX_LABELLED`` in all, in order of place and label.  Texts are shuffled once; no round shuffles features."""
    def read(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "label"])
        found = Features.of(group["text"].tolist()).shares()
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "labels": [group["label"].to_numpy(np.int8).tobytes()],
                             "sizes": [np.array([len(b) for b, _ in found], np.int64).tobytes()],
                             "buckets": [np.concatenate([b for b, _ in found]).astype(np.int32).tobytes()],
                             "shares": [np.concatenate([s for _, s in found]).astype(np.float32).tobytes()]})

    dealt = sample.withColumn("shard", F.pmod("place", F.lit(SHARDS)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(read, "shard int, labels binary, sizes binary, buckets binary, shares binary")


def _round(shards: DataFrame, model: QualityModel, rate: float, step: int) -> QualityModel:
    """The average, weighted by documents, of the models that the shards make from ``model`` in one epoch."""
    shared = shards.sparkSession.sparkContext.broadcast(model)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch.itertuples(index=False):
                labels, ends = np.frombuffer(shard.labels, np.int8), np.cumsum(np.frombuffer(shard.sizes, np.int64))[:-1]
                buckets, shares = np.frombuffer(shard.buckets, np.int32), np.frombuffer(shard.shares, np.float32)
                rows = [(b.astype(np.int64), s.astype(float)) for b, s in zip(np.split(buckets, ends), np.split(shares, ends), strict=True)]
                made = epoch(shared.value, rows, labels, rate, step)
                yield pd.DataFrame({"shard": [shard.shard], "n": [len(labels)], "vectors": [made.vectors.astype(np.float32).tobytes()],
                                    "output": [made.output.tobytes()]})

    parts = sorted(shards.mapInPandas(train, "shard int, n long, vectors binary, output binary").collect())  # a model a shard
    shared.unpersist()
    total = sum(p["n"] for p in parts)
    if not total:
        return model
    vectors = sum((np.frombuffer(p["vectors"], np.float32).astype(float) * (p["n"] / total) for p in parts), np.zeros(BUCKETS * DIM))
    output = sum((np.frombuffer(p["output"]) * (p["n"] / total) for p in parts), np.zeros(2 * DIM))
    return QualityModel(vectors.reshape(BUCKETS, DIM), output.reshape(2, DIM))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", held_out: int = HELD_OUT,
          min_score: float = MIN_SCORE) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score (probability of label 1), predicted.

    A null text counts as empty: it has the end mark alone. Of a null id ``held_out`` is null. Repeated rows are scored each;
    an empty table gives no rows; other columns are left out, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.weight())

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odds = Features.of(batch["text"].tolist()).average(shared.value)
            value = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pd.DataFrame({"id": batch["id"], "score": value, "predicted": (value >= min_score).astype(int)})

    made = by_row(docs, judge, id_col, "score double, predicted int", text=text_col)
    return made.select(id_col, (F.crc32(F.col(id_col).cast("string").cast("binary")) % held_out == 0).alias("held_out"), "score", "predicted")
