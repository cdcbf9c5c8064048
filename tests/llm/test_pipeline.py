import corpus_pipeline
from llm_brute import decontaminated, jaccard, secrets, sha

from orderflow.llm import queries, secret_scan, toxicity
from orderflow.llm.bpe import ForcedBoundaryBPE, default_vocabulary
from orderflow.llm.common import table

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(llm_spark):
    docs = table(llm_spark, SMALL, "documents")
    items = [tuple(r) for r in table(llm_spark, SMALL, "benchmark").select("item_id", "text").collect()]
    model = toxicity.fit(docs, table(llm_spark, SMALL, "labels"))
    said = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()}
    kept = {r["doc_id"]: r.asDict() for r in docs.collect() if not said[r["doc_id"]]}
    near = jaccard([(i, r["text"]) for i, r in kept.items()])
    kept = {i: r for i, r in kept.items() if near[i][1] == i}
    hit = decontaminated([r["text"] for r in kept.values()], items)
    kept = {i: r for (i, r), h in zip(kept.items(), hit, strict=True) if not h[-1]}

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(llm_spark, now, SMALL)
        assert now.columns == docs.columns, name
    got = {r["doc_id"]: r for r in now.collect()}
    assert set(got) == set(kept) and 0 < len(kept) < docs.count()
    for i, r in got.items():
        assert not secrets(r["text"].replace(f"{'[SECRET]'}", " ")) and r["n_chars"] == len(r["text"])
        if not secret_scan.base_spans(kept[i]["text"]):
            assert r["text"] == kept[i]["text"]
        assert (r["lang"], r["source"]) == (kept[i]["lang"], kept[i]["source"])
    bpe = ForcedBoundaryBPE(default_vocabulary())
    want = {(i, len(bpe.encode(r["text"])) // 4, sha(bpe.encode(r["text"])), sha(r["text"])) for i, r in got.items()}
    assert {tuple(r) for r in corpus_pipeline.run(llm_spark, SMALL).collect()} == want


def test_nulls_repeated_rows_long_texts_and_clashing_columns(llm_spark):
    names = ["_gone", "id", "rep", "text_", "component", "key", "component_id"]
    base = table(llm_spark, SMALL, "documents").limit(60)
    clean = "Plain words that nobody would mind at all, number {} of a row of them in a long quiet text. "
    rows = [(90_001, None), (90_002, ""), (None, clean.format("none") * 3), (None, None), (90_003, clean.format(3)), (90_003, clean.format(3)),
            (90_004, "".join(clean.format(i) for i in range(20_000))), (90_005, "  \n\t "), (90_006, clean.format(6) + "password=abcdefgh1234")]
    extra = llm_spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "CAST(NULL AS STRING) AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    docs = base.unionByName(extra).selectExpr("*", *(f"'{n}' AS {n}" for n in names))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(llm_spark, now, SMALL)
        assert now.schema.names == docs.schema.names, name
    kept = now.collect()
    assert all(r[n] == n for r in kept for n in names)
    ours = [(r["doc_id"], r["text"]) for r in kept if r["doc_id"] is None or r["doc_id"] > 90_000]
    want = [(i, t.replace("password=abcdefgh1234", "[SECRET]") if t else t) for i, t in rows]
    assert sorted(ours, key=str) == sorted(want, key=str)
    last = corpus_pipeline.STAGES[-1][1](llm_spark, now, SMALL).collect()
    assert len(last) == len(kept) and {r["n_tokens"] for r in last if r["doc_id"] in (90_001, 90_002)} == {0}


def test_empty_documents(llm_spark):
    docs = table(llm_spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm_spark, docs, SMALL).count() == 0


def test_registered(llm_spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit() and n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(entry.queries())
