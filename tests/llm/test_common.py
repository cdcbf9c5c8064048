from orderflow.llm.common import by_row, pack, packed, saved, unpack, unpacked


def test_packed_text_comes_back(llm_spark):
    for text in ("", "a", "é中🙂" * 1000, None):
        assert unpack(pack(text)) == text
    df = llm_spark.createDataFrame([(1, "text " * 100), (2, None), (3, "")], "id long, text string")
    light = df.withColumn("text", packed("text"))
    assert dict(light.dtypes)["text"] == "binary"
    assert sorted(map(tuple, light.withColumn("text", unpacked("text")).collect())) == sorted(map(tuple, df.collect()))


def test_ids_stay_whole_beside_nulls(llm_spark):
    big = 2**62 + 1
    df = llm_spark.createDataFrame([(big, "a"), (None, "b")], "doc_id long, text string")
    out = by_row(df, lambda batches: (b.rename(columns={"text": "t"}) for b in batches), "doc_id", "t string", text="text")
    assert {tuple(r) for r in out.collect()} == {(big, "a"), (None, "b")}


def test_saved_tables_keep_rows_and_schema(llm_spark):
    df = llm_spark.createDataFrame([(1, ["x", None])], "a long, b array<string>")
    again = saved(df, "test")
    assert again.schema == df.schema and again.collect() == df.collect()
