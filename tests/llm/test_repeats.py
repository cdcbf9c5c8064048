import hashlib
import random

import pytest
from pyspark.sql import types as T

from orderflow.llm import repeats
from orderflow.llm.common import prepare

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("spans", T.StringType()), T.StructField("key", T.IntegerType())])


def brute(docs, window):
    """Removed bytes of each (id, text), by the definition."""
    first = {}
    named = sorted({(i, t or "") for i, t in docs if i is not None})
    for i, t in named:
        raw = t.encode()
        for s in range(len(raw) - window + 1):
            first.setdefault(raw[s:s + window], (i, s))
    out = {}
    for i, t in named:
        raw = t.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - window + 1):
            if first[raw[s:s + window]] != (i, s):
                gone[s:s + window] = b"\1" * window
        spans, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            at = gone.find(0, a)
            at = len(raw) if at < 0 else at
            spans.append([a, at])
        out[i, t] = spans
    return out


def corpus(seed, alphabet, n, longest):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, longest))) for _ in range(12)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.15:
            docs.append((i, rng.choice(docs)[1]))  # a copy
        elif docs and kind < 0.35:  # a near copy
            t = list(rng.choice(docs)[1] or "ab")
            for _ in range(rng.randint(1, 3)):
                t[rng.randrange(len(t))] = rng.choice(alphabet)
            docs.append((i, "".join(t)))
        else:
            docs.append((i, "".join(rng.choice(pieces) if rng.random() < 0.4 else "".join(
                rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 8)))))
    rng.shuffle(docs)
    return docs


def run(spark, docs, settings, what=repeats.repeat_spans):
    prepare(spark)
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in docs], SCHEMA).repartition(5)
    return what(df, settings=settings)


@pytest.mark.parametrize(("seed", "alphabet", "window", "cores", "least"), [
    (1, "ab", 12, (4, 8, 11, 12), 2), (2, "abcé", 12, (4, 9, 11, 12), 1000), (3, "a", 10, (3, 6, 9, 10), 3),
    (4, "abcdefgh", 20, (8, 16, 19, 20), 1), (5, "abc", 16, (5, 12, 15, 16), 4)])
def test_same_spans_as_the_definition(spark, seed, alphabet, window, cores, least):
    docs = corpus(seed, alphabet, 150, 40)
    want = brute(docs, window)
    got = run(spark, docs, repeats.Settings(window, cores, 0.0, least)).collect()
    assert len(got) == len(docs)
    for r in got:
        assert [list(s) for s in r["spans"]] == want[r["doc_id"], r["text"] or ""], r


def test_production_settings_over_long_passages(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, longer = prose(25), prose(120)
    docs = [(i, prose(rng.randint(0, 60)) + (" " + passage + " " if i % 3 == 0 else " ") + prose(20)) for i in range(120)]
    docs += [(200 + i, longer[:300] + prose(3) + longer[300:]) for i in range(20)]
    docs += [(300 + i, "the " * 200 + prose(5)) for i in range(10)] + [(400, prose(30) * 3)]
    docs += [(i + 500, docs[i][1]) for i in range(40)]
    rng.shuffle(docs)
    want = brute(docs, 100)
    for r in run(spark, docs, repeats.Settings()).collect():
        assert [list(s) for s in r["spans"]] == want[r["doc_id"], r["text"]], r["doc_id"]
    found = run(spark, docs, repeats.Settings(), repeats.digest).collect()
    for r in found:
        text = dict(docs)[r["doc_id"]]
        spans = want[r["doc_id"], text]
        kept = repeats.kept_bytes(text, spans)
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(text.encode()), len(text.encode()) - len(kept), len(spans))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_nulls_empty_texts_repeated_rows_and_empty_tables(spark):
    long = "x" * 40 + "".join(chr(97 + i % 23) for i in range(400))
    docs = [(3, long), (3, long), (None, long), (None, None), (4, None), (5, ""), (6, "short"), (1, long), (7, "y" + long)]
    got = {}
    for r in run(spark, docs, repeats.Settings()).collect():
        got.setdefault((r["doc_id"], r["text"]), []).append([list(s) for s in r["spans"]])
    want = brute(docs, 100)
    assert got[3, long] == [[[0, 440]]] * 2
    assert got[None, long] == [[]]
    assert got[None, None] == [[]]
    assert got[1, long] == [want[1, long]]
    assert got[7, "y" + long] == [want[7, "y" + long]]
    assert got[4, None] == got[5, ""] == got[6, "short"] == [[]]
    empty = run(spark, [], repeats.Settings())
    assert empty.count() == 0
    assert run(spark, [], repeats.Settings(), repeats.digest).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_repeated_rows_without_a_smaller_copy(spark):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    part, own = text(150), [text(rng.randint(100, 700)) for _ in range(12)]
    docs = [(i, t) for i, t in enumerate(own)] * 6
    docs += [(20, part + text(300))] * 5 + [(21, text(50) + part + text(80))] * 5 + [(22, text(30) + part + text(9) + part)] * 4
    docs += [(19, own[3][:99] + "#" + own[3][99:])] * 3
    rng.shuffle(docs)
    want = brute(docs, 100)
    assert not any(want[i, t] for i, t in enumerate(own)) and want[21, dict(docs)[21]]
    for settings in (repeats.Settings(), repeats.Settings(frequent_share=0.0, frequent_least=1)):
        got = run(spark, docs, settings).collect()
        assert len(got) == len(docs)
        for r in got:
            assert [list(s) for s in r["spans"]] == want[r["doc_id"], r["text"]], r["doc_id"]


def test_equal_places_are_not_earlier_than_each_other():
    left, right = b"x" * 10, b"y" * 10
    assert repeats.key_spans([left] * 3, [right] * 3, 10, [1, 1, 1]) == []
    assert sorted(repeats.key_spans([left] * 3, [right] * 3, 10, [1, 1, 2])) == [(2, 10, 10)]
    assert sorted(repeats.key_spans([left, left + b"a", left], [right] * 3, 10, [1, 1, 2])) == [(2, 10, 10)]


def test_text_without_repeats(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "é" * 100), (2, None), (3, "aé" * 30 + "b")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(df, settings=repeats.Settings(9, (3, 6, 8, 9))).collect()}
    assert got[2] is None
    assert got[1] == "é"  # from its second character on every nine bytes started earlier
    assert got[3] == "aéb"


def test_intervals_have_all_occurrences():
    words = sorted([b"banana"[i:] for i in range(6)])
    common = repeats._common(*repeats._matrix(words, 6))
    groups = {(n, tuple(words[a:b + 1])) for n, a, b in repeats._intervals(common) if n}
    assert groups == {(3, (b"ana", b"anana")), (1, (b"a", b"ana", b"anana")), (2, (b"na", b"nana"))}
