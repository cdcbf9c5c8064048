"""Rounds of the quality fit read the shards as they were written: nothing is shuffled anew."""
from orderflow.llm import quality as Q


def test_rounds_shuffle_nothing(llm_spark, monkeypatch):
    docs = llm_spark.createDataFrame([(i, f"text number {i} {'good' if i % 2 else 'bad bad'}") for i in range(60)], "doc_id long, text string")
    labels = llm_spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    kept, save = [], Q.saved
    monkeypatch.setattr(Q, "saved", lambda df, name: kept.append(save(df, name)) or kept[-1])
    plans, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    model = Q.fit(docs, labels)
    assert len(plans) == Q.EPOCHS and not any("Exchange" in p for p in plans)
    assert sorted(r.shard for r in kept[0].select("shard").toLocalIterator()) == [*range(Q.SHARDS)]
    assert model.vectors.any()
