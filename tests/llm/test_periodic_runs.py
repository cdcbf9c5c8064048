import random
import re
import time
import zlib

import numpy as np
import pytest
from llm_brute import sha
from pyspark.sql import functions as F

from orderflow.llm import periodic_runs as P


def brute_runs(words, min_exponent=4, min_words=6):
    """Every maximal stretch of every period; of equal ends the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_words, min_exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def random_words(rng, n):
    """Words of few kinds, with periodic stretches inside one another."""
    out = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(max(1, n))
        p = rng.randrange(1, max(2, (n - a) // 3))
        end = min(n, a + p * rng.randrange(2, 9) + rng.randrange(p))
        out[a:end] = [out[a + (i - a) % p] for i in range(a, end)]
    return out


@pytest.mark.parametrize("exponent", [2, 3, 4])
def test_equals_brute_force(exponent):
    rng = random.Random(exponent)
    docs = [[w.encode() for w in random_words(rng, rng.randrange(0, 180))] for _ in range(250)]
    got = P.runs_of(docs, exponent, 3)
    for words, runs in zip(docs, got, strict=True):
        assert sorted(map(tuple, runs.tolist())) == brute_runs(words, exponent, 3)


def test_words_appended_one_by_one_or_in_any_chunks_give_the_same():
    rng = random.Random(9)
    for _ in range(25):
        words = np.array([int(w) for w in random_words(rng, 150)])
        whole, single, mixed = (P.RunCatcher(4) for _ in range(3))
        whole.append(words)
        for w in words:
            single.append(np.array([w]))
        at = 0
        while at < len(words):
            step = rng.randrange(1, 40)
            mixed.append(words[at:at + step])
            at += step
        want = [tuple(r) for r in whole.finish().tolist()]
        assert [tuple(r) for r in single.finish().tolist()] == want == [tuple(r) for r in mixed.finish().tolist()]


def test_small_chunks_of_long_streams(monkeypatch):
    rng = random.Random(4)
    docs = [[w.encode() for w in random_words(rng, n)] for n in (900, 901, 700)]
    want = P.runs_of(docs)
    monkeypatch.setattr(P, "CHUNK", 97)
    for a, b, words in zip(want, P.runs_of(docs), docs, strict=True):
        assert a.tolist() == b.tolist() == sorted(map(list, brute_runs(words)), key=lambda r: (r[0], r[2]))


def test_a_clash_of_hashes_does_not_show(monkeypatch):
    monkeypatch.setattr(P, "mix64", lambda h: h & np.uint64(3))  # most words alike
    rng = random.Random(2)
    for _ in range(20):
        words = [w.encode() for w in random_words(rng, 80)]
        for a, b, q in P.runs_of([words])[0].tolist():
            assert (a, b, q) in brute_runs(words)


def test_long_texts_take_seconds():
    began = time.time()
    same = P.runs_of([[b"x"] * 1_000_000])[0]
    assert same.tolist() == [[0, 1_000_000, 1]]
    period = [str(i).encode() for i in range(100_000)]
    assert P.runs_of([period * 8 + period[:7]])[0].tolist() == [[0, 800_007, 100_000]]
    fib = [b"a"], [b"b"]
    while len(fib[1]) < 300_000:
        fib = fib[1], fib[1] + fib[0]
    P.runs_of([fib[1]])
    assert time.time() - began < 60


def test_thue_morse_has_no_cube():
    words = [bin(i).count("1") % 2 for i in range(1 << 14)]
    assert P.runs_of([[str(w).encode() for w in words]], 3, 1)[0].tolist() == []


def test_rows_equal_brute_force(llm_spark):
    rng = random.Random(7)
    texts = [" ".join(random_words(rng, rng.randrange(0, 150))) for _ in range(300)]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rows += [(1000, None, None), (1001, "", "y"), (1002, " \t\n ", None), (5, texts[5], "z"), (None, "a b " * 30, None),
             (1003, "é é  b\x0bc\r\nd " * 9, "w"), (1004, "a " * 5, "q"), (1005, "a " * 6, "q")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, _w string").withColumn("runs", F.lit(1))
    got = P.digest(P.periodic_runs(P.with_planted_runs(docs))).collect()
    want = [brute_row(i, t) for i, t, _ in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert sum(r[1] for r in want) > 50


def test_empty_table_and_schema(llm_spark):
    docs = llm_spark.createDataFrame([], "doc_id int, text string, n_runs int")
    got = P.digest(P.periodic_runs(P.with_planted_runs(docs)))
    assert got.collect() == []
    assert got.dtypes == [("doc_id", "int"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
                          ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]


def test_registered_query_equals_brute_force(llm_spark):
    from orderflow.llm.queries import QUERIES
    docs = llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_periodic_runs"](llm_spark, "/root/testdata/sf0.001").collect()}
    short = [r for r in docs if len((r["text"] or "").split()) < 600]
    assert len(got) == len(docs) and len(short) > 100
    for r in short:
        assert got[r["doc_id"]] == brute_row(r["doc_id"], r["text"])
