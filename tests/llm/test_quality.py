import zlib

import numpy as np
import pandas as pd
import pytest

from orderflow.llm import quality as Q
from orderflow.llm.common import mix64

SF = "/root/testdata/sf0.01"
MASK = 2**64 - 1


def plain_bucket(value):
    return int(mix64(np.array([value & MASK], np.uint64))[0]) % Q.BUCKETS


def plain_features(text):
    """Buckets of every feature of a text, by the definition."""
    words, out = (text or "").split(), [plain_bucket(int(Q._END))]
    hashed = [int(mix64(pd.util.hash_array(np.array([w.encode()], object), categorize=False))[0]) for w in words]
    for w, h in zip(words, hashed, strict=True):
        out.append(plain_bucket(h))
        marked = f"<{w}>"
        for n in Q.GRAMS:
            for i in range(len(marked) - n + 1):
                value = n
                for j, c in enumerate(marked[i:i + n]):
                    value = (value * int(Q._M[0]) + ord(c) * int(Q._M[1 + j % 3])) & MASK
                out.append(plain_bucket(value))
    for i in range(len(words) - 1):
        same = words[i] == words[i + 1]
        out.append(plain_bucket(int(Q._AGAIN) if same else hashed[i] * int(Q._M[2]) + hashed[i + 1] * int(Q._M[3])))
    return out


TEXTS = ["ab cd ab", None, "", "  \n ", "aaa aaa aaa", "größe ÜBER x", "a" * 5000, "word " * 3000, "😀 é x", "x"]


def test_features_equal_their_definition():
    weight = np.random.default_rng(1).normal(size=Q.BUCKETS)
    found = Q.Features.of(TEXTS)
    for text, mean, (buckets, share) in zip(TEXTS, found.average(weight), found.shares(), strict=True):
        plain = plain_features(text)
        assert mean == pytest.approx(weight[plain].mean())
        assert dict(zip(buckets.tolist(), share.tolist(), strict=True)) == pytest.approx(
            {b: plain.count(b) / len(plain) for b in set(plain)})
    assert Q.Features.of([]).average(weight).tolist() == []


def test_a_step_goes_down_the_gradient(monkeypatch):
    """Against numeric slopes of minus the log-likelihood of one document."""
    monkeypatch.setattr(Q, "BUCKETS", 7)
    rng = np.random.default_rng(3)
    model = Q.QualityModel(rng.normal(size=(7, Q.DIM)), rng.normal(size=(2, Q.DIM)))
    row = (np.array([1, 4]), np.array([0.25, 0.75]))

    def loss(vectors, output):
        z = output @ (row[1] @ vectors[row[0]])
        return -(z[0] - np.log(np.exp(z).sum()))

    rate = 1e-4
    made = Q.epoch(model, [row], np.array([0]), rate, 0)
    tiny = 1e-6
    for at in ((1, 0), (4, Q.DIM - 1), (2, 2)):
        moved = model.vectors.copy()
        moved[at] += tiny
        slope = (loss(moved, model.output) - loss(model.vectors, model.output)) / tiny
        assert (model.vectors - made.vectors)[at] == pytest.approx(rate / (row[1] @ row[1]) * slope, abs=1e-9)
    moved = model.output.copy()
    moved[1, 3] += tiny
    slope = (loss(model.vectors, moved) - loss(model.vectors, model.output)) / tiny
    # the output's step follows that of the vectors by the same slopes
    assert (model.output - made.output)[1, 3] == pytest.approx(rate * slope, abs=1e-9)


def test_score_equals_softmax_of_the_average(llm_spark):
    rng = np.random.default_rng(4)
    model = Q.QualityModel(rng.normal(size=(Q.BUCKETS, Q.DIM)) * 5, rng.normal(size=(2, Q.DIM)))
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(1, "again", None), (None, "ab", None)]
    got = Q.score(llm_spark.createDataFrame(rows, "doc_id int, text string, score string"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        text = [t for i, t, _ in rows if i == r["doc_id"]]
        want = []
        for t in text:
            z = model.output @ model.vectors[plain_features(t)].mean(axis=0)
            want.append(np.exp(z[1]) / np.exp(z).sum())
        assert any(r["score"] == pytest.approx(w) for w in want)
        assert r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_tables_without_rows_or_labels(llm_spark):
    none = llm_spark.createDataFrame([], "doc_id long, text string")
    unlabelled = llm_spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    some = llm_spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert Q.score(none, Q.fit(none, unlabelled)).collect() == []
    assert [r["score"] for r in Q.score(some, Q.fit(some, unlabelled)).collect()] == [0.5, 0.5]


def test_held_out_labels_and_other_columns_are_not_read(llm_spark):
    docs = llm_spark.createDataFrame([(i, f"{'bad ###' if i % 2 else 'good text'} {i}", "en", "s") for i in range(200)],
                                     "doc_id long, text string, lang string, source string")
    labels = [(i, 1 - i % 2) for i in range(200)]
    turned = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q) for i, q in labels]
    a, b = (Q.fit(docs.withColumnRenamed("lang", "quality") if x is turned else docs, llm_spark.createDataFrame(x + x[:3], "doc_id long, quality int"))
            for x in (labels, turned))
    assert (a.vectors == b.vectors).all() and (a.output == b.output).all()
    scores = {r["doc_id"]: r["score"] for r in Q.score(docs, a).collect()}
    assert all((scores[i] > 0.5) == bool(q) for i, q in labels)


def test_held_out_accuracy(llm_spark):
    from orderflow.llm.queries import QUERIES
    labels = {r["doc_id"]: r["quality"] for r in llm_spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op13_quality"](llm_spark, SF).collect()
    assert len(got) == llm_spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([r["score"] for r in held if labels[r["doc_id"]] == q] for q in (1, 0))
    assert len(good) > 30 and len(bad) > 3
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([(r["predicted"] == labels[r["doc_id"]]) for r in held]) > 0.9
