import random
import zlib
from collections import defaultdict

import pytest

from orderflow.llm import sharding as S


def feasible(sizes, capacity, shards):
    used, at = 1, 0
    for s in sizes:
        if s > capacity:
            return False
        if at + s > capacity:
            used, at = used + 1, 0
        at += s
    return used <= shards


def best(sizes, shards):
    return next(c for c in range(max(sizes), sum(sizes) + 1) if feasible(sizes, c, shards))


@pytest.mark.parametrize("seed", range(6))
def test_search_over_key_ranges_finds_the_least_capacity(seed):
    rng = random.Random(seed)
    keys = sorted(rng.sample(range(1 << S.KEY_BITS), 500))
    sizes = [rng.choice([1, 5, 9, rng.randint(1, 400)]) for _ in keys]
    if seed % 2:
        sizes[rng.randrange(500)] = 40_000
    shards = rng.choice([2, 5, 8])
    exact = S.Ranges(keys, [0] * 500, sizes)
    assert exact.least(shards, False) == exact.least(shards, True) == best(sizes, shards)
    coarse = defaultdict(int)
    for k, s in zip(keys, sizes, strict=True):
        coarse[k >> 55] += s
    rough = S.Ranges([k << 55 for k in sorted(coarse)], [55] * len(coarse), [coarse[k] for k in sorted(coarse)])
    assert rough.least(shards, True) <= best(sizes, shards) <= rough.least(shards, False)


def check(rows, docs, shards):
    text_of = dict(docs)
    groups, sums, slots, shard_of = {}, defaultdict(int), defaultdict(list), {}
    for r in rows:
        text = text_of[r["doc_id"]]
        raw = (text or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        groups[r["key"]] = groups.get(r["key"], 0) + r["size"]
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) == best([groups[k] for k in sorted(groups)], shards)
    order = sorted((r["key"], r["shard"]) for r in rows)
    assert [s for _, s in order] == sorted(s for _, s in order)  # contiguous


@pytest.mark.parametrize(("seed", "n", "shards"), [(1, 300, 8), (2, 60, 8), (3, 200, 3), (4, 5, 8)])
def test_shards_of_documents(llm_spark, monkeypatch, seed, n, shards):
    monkeypatch.setattr(S, "NUMBERED_ROWS", 20)
    rng = random.Random(seed)
    docs = [(i, "é" * rng.randint(0, 80)) for i in range(n)] + [(1000 + i, "hot text " * 9) for i in range(n // 2)] + [(2000, None), (2001, None), (2002, "")]
    rng.shuffle(docs)
    df = llm_spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, shard string, key int")
    rows = S.minimax_shards(df, shards).collect()
    assert len(rows) == len(docs)
    check(rows, docs, shards)


def test_empty_table_repeated_rows_and_null_ids(llm_spark):
    df = llm_spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")
    rows = S.digest(S.minimax_shards(df, 2)).collect()
    assert len(rows) == 4 and len({(r["shard"], r["slot"]) for r in rows}) == 4
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    empty = S.digest(S.minimax_shards(df.limit(0)))
    assert empty.count() == 0
    assert empty.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"),
                            ("slot", "bigint"), ("grown_shard", "int")]


def test_written_shards(llm_spark, tmp_path):
    docs = [(i, f"text {i % 40}", i) for i in range(200)]
    df = llm_spark.createDataFrame(docs, "doc_id long, text string, extra int")
    sharded = S.minimax_shards(df, 4)
    S.write_shards(df, sharded, f"{tmp_path}/shards")
    want = {r["doc_id"]: r["shard"] for r in sharded.collect()}
    got = llm_spark.read.parquet(f"{tmp_path}/shards").collect()
    assert {r["doc_id"]: r["shard"] for r in got} == want and len(got) == 200 and got[0]["extra"] == got[0]["doc_id"]
