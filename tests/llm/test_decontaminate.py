import random

from llm_brute import decontaminated

from orderflow.llm import decontaminate as D

WORDS = ["The", "quick", "été", "fox42", "x", "y", "ÉTÉ", "z9"]


def case(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(WORDS) + rng.choice([" ", ", ", "-", "\n", "\x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(14)] + [(3, "x"), (99, None), (None, "quick fox42 z9 quick"), (7, "")]
    docs = [(i, text(rng.randint(0, 40)) + rng.choice([t or "" for _, t in items]) + text(rng.randint(0, 9))) for i in range(80)]
    return docs + [(100, None), (101, ""), (None, "x x"), (5, docs[5][1]), (102, "..!!")], items


def test_same_as_brute_force_in_one_block_and_in_many(llm_spark):
    for seed, chars in ((1, 10**6), (2, 60), (3, 300)):
        docs, items = case(seed)
        if seed == 2:
            items = [x for x in items if x[1] and len(x[1]) > 60]
        df = llm_spark.createDataFrame([(i, t, "q", 1) for i, t in docs], "doc_id long, text string, spans string, n_words int")
        bench = llm_spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, n string")
        got = sorted(map(tuple, D.digest(D.decontaminate(df, bench, block_chars=chars)).collect()), key=str)
        want = sorted(((i, *w) for (i, _), w in zip(docs, decontaminated([t for _, t in docs], items), strict=True)), key=str)
        assert got == want
        clean = sorted(map(tuple, D.clean_documents(df, bench, block_chars=chars).collect()), key=str)
        assert clean == sorted(((i, t, "q", 1) for (i, t), w in zip(docs, decontaminated([t for _, t in docs], items), strict=True) if not w[-1]), key=str)


def test_spans_are_maximal_runs():
    table = D.WindowTable([(1, "a b c"), (2, "c d e"), (3, "q")], 3)
    assert table.scan(D.words_of("x A b, c d e y q q")) == ([[1, 6], [7, 9]], [1, 2, 3])
    assert table.scan([]) == ([], [])


def test_empty_tables(llm_spark):
    docs = llm_spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = llm_spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.digest(D.decontaminate(docs, bench.limit(0))).first()["contaminated"] is False
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    assert D.clean_documents(docs, bench.limit(0)).count() == 1
    assert D.digest(D.decontaminate(docs, bench)).first()["n_hit"] == 3


def test_long_text(llm_spark):
    text = "word " * 300_000 + "alpha beta gamma delta eps zeta eta theta iota kappa " + "word " * 10
    docs = llm_spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = llm_spark.createDataFrame([(4, "Alpha beta gamma delta eps zeta eta theta iota kappa")], "item_id long, text string")
    row = D.decontaminate(docs, bench).first()
    assert [list(s) for s in row["spans"]] == [[300_000, 300_010]] and list(row["items"]) == [4]
