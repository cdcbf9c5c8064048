import random

import numpy as np

from orderflow.llm import toxicity as X
from orderflow.llm.common import table


def case(seed, n=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 6) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grumpf", "snorx", "zwil" + word(), "Blargh"]))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_held_out_documents(llm_spark):
    rows = case(1)
    docs = llm_spark.createDataFrame([(i, t, 0) for i, t, _ in rows], "doc_id long, text string, toxic int")
    labels = llm_spark.createDataFrame([(i, x) for i, _, x in rows if i < 280], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 2
    got = {r["doc_id"]: r for r in X.score(docs, model).collect()}
    held = [(got[i]["toxic"], bool(x)) for i, _, x in rows if i >= 280]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert sum(a for a, b in held if not b) <= 1
    clean = {i for i, t, _ in rows if not got[i]["toxic"]}
    assert {r["doc_id"] for r in X.reject_toxic(docs, model).collect()} == clean


def test_held_out_accuracy_on_the_tables(llm_spark):
    docs, labels = (table(llm_spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = X.fit(docs, labels.where("doc_id % 5 <> 0"))
    held = X.score(docs, model).withColumnRenamed("toxic", "said").join(labels.where("doc_id % 5 = 0"), "doc_id").select("said", "toxic").collect()
    caught, wrong = (sum(r["said"] for r in held if r["toxic"] == k) for k in (1, 0))
    assert caught >= 0.75 * sum(r["toxic"] for r in held)  # some of the labels are noise
    assert wrong <= 0.01 * len(held)


def test_one_weight_vector_and_rising_thresholds():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 4, 3000)
    grades = np.clip(z + rng.integers(-1, 2, 3000) - 1, 0, 2)
    weights, limits = X.fit_ordinal([{0: float(v)} if v else {} for v in z], grades, 1)
    assert weights[0] > 0 and limits[0] < limits[1]
    model = X.OrdinalModel({"bad": float(weights[0])}, tuple(limits))
    severity = [sum(model.at_least(model.linear({"bad": n}))) for n in (0, 1, 3, 9)]
    assert severity == sorted(severity)


def test_nulls_empty_texts_one_class_and_empty_tables(llm_spark):
    rows = case(2, 80)
    docs = llm_spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "grumpf"), (0, rows[0][1])], "doc_id long, text string")
    labels = llm_spark.createDataFrame([(i, x) for i, _, x in rows] + [(900, 1), (901, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    got = X.score(docs, model).collect()
    assert len(got) == 84 and not next(r for r in got if r["doc_id"] == 900)["toxic"]
    for none in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        blank = X.fit(docs, none)
        assert {(r["severity"], r["grade"], r["toxic"]) for r in X.score(docs, blank).collect()} == {(0.0, 0, False)}
    assert X.score(docs.limit(0), model).count() == 0
    assert X.fit(docs.limit(0), labels).thresholds == ()
    assert X.reject_toxic(docs, X.OrdinalModel()).count() == 84


def plain_severity(model, text):
    """The expected severity by the formula, over all features of the text."""
    z = sum(model.weights[f] * np.log(1 + n) for f, n in X.features(text).items() if f in model.weights)
    return sum(1 / (1 + np.exp(t - z)) for t in model.thresholds)


def test_scores_equal_the_formula(llm_spark):
    model = X.OrdinalModel({"bad": 1.5, "gru*": 0.7, "grum*": 0.2, "über*": 2.0, "worse": 3.0}, (1.0, 2.5))
    texts = [None, "", "bad bad grumpf gru GRUMPY", "überall übel worse", "fine", "bad " * 50, "Bad! grumpf-worse"]
    got = X.score(llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        want = plain_severity(model, texts[r["doc_id"]])
        assert abs(r["severity"] - want) < 1e-6 and r["toxic"] == (want >= X.MIN_SEVERITY)
    for text in texts:  # counting what the model knows alone, whatever was seen before
        assert model.counts(text) == {f: n for f, n in X.features(text).items() if f in model.weights}


def test_fit_is_the_least_of_a_grid():
    """The fitted weight and thresholds against every point of a grid of the penalised log-likelihood."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, 400).astype(float)
    grades = np.clip(np.digitize(1.3 * x + rng.logistic(size=400), [1.5, 4.0]), 0, 2)

    def loss(w, a, b):
        below = 1 / (1 + np.exp(np.stack([w * x - a, w * x - b])))
        edges = np.concatenate((np.zeros((1, 400)), below, np.ones((1, 400))))
        mass = edges[grades + 1, np.arange(400)] - edges[grades, np.arange(400)]
        return -np.log(np.maximum(mass, 1e-12)).mean() + X.RIDGE / 2 * w * w

    weights, limits = X.fit_ordinal([{0: v} if v else {} for v in x], grades, 1)
    fitted = loss(weights[0], *limits)
    grid = [loss(w, a, a + g) for w in np.arange(0, 3, 0.1) for a in np.arange(-1, 4, 0.1) for g in np.arange(0.2, 5, 0.2)]
    assert fitted <= min(grid) + 1e-6


def test_texts_of_the_same_shingles_count_once_with_their_own_label(llm_spark):
    """Documents that share a passage are documents of their own; a clean text isn't fitted as toxic for it."""
    head = "this same long head stands before every text of the source and goes on for a while "
    rows = [(i, head + ("fine words " * 3 + f"clean {i}" if i % 3 else f"grumpf snorx grumpf toxic {i}"), int(i % 3 == 0)) for i in range(120)]
    docs = llm_spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900 + k, rows[0][1]) for k in range(50)], "doc_id long, text string")
    labels = llm_spark.createDataFrame([(i, x) for i, _, x in rows] + [(900 + k, 0) for k in range(50)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    got = {r["doc_id"]: r["toxic"] for r in X.score(docs, model).collect()}
    assert all(got[i] == bool(x) for i, _, x in rows)
