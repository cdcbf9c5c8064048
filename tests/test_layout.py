"""Store layout (date partitions, clustered files) and the lane-partitioned sink."""
import contextlib
import io

from pyspark.sql import functions as F

from orderflow.operators import documents as D
from orderflow.operators import lookup as L
from orderflow.operators import store as ST
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX

from paths import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_store_layout_prunes_dates_and_retention(spark):
    path = scratch_path(spark, "test-store")
    docs = FX.order_docs(spark, SF_SMALL)
    ST.write_store(docs, path)
    store = ST.scan_orders(spark, path)
    assert store.count() == docs.count()
    recent = store.filter(F.col("event_date") >= F.lit("2001-05-01").cast("date"))
    p = plan(L.orders_by_status(recent, "SHIPPED"))
    assert "PartitionFilters: [isnotnull(event_date" in p and "PushedFilters" in p
    kept = ST.apply_retention(store, FX.as_of())
    assert kept.count() == ST.apply_retention(docs, FX.as_of()).count()


def test_topic_records_written_per_lane(spark):
    path = scratch_path(spark, "test-topic")
    records = D.to_topic_records(FX.order_events(spark, SF_SMALL, with_items=False))
    D.write_orders(records, path)
    D.write_orders(records, path)  # the same batch again replaces itself
    back = spark.read.parquet(path)
    assert back.count() == records.count()
    assert {r.partition for r in back.select("partition").distinct().collect()} <= {0, 1, 2, 3}
    premium = back.filter(F.col("key").startswith("PREMIUM:"))
    assert {r.partition for r in premium.select("partition").distinct().collect()} == {0}
    p2 = D.to_topic_records(FX.lifecycle_orders(FX.order_docs(spark, SF_SMALL)).withColumnRenamed(
        "createdAt", "eventTimestamp"), routing="priority", fields=["orderId", "customerId", "priority"])
    lanes = {(r.key.split(":")[0], r.partition) for r in p2.collect()}
    assert all((pr == "FLASH_SALE") == (ln >= 6) and (pr == "EXPRESS") == (ln in (4, 5)) for pr, ln in lanes)


def test_hot_day_is_split_and_expired_folders_go(spark):
    from orderflow.sources import fixtures
    path = scratch_path(spark, "test-hot-day")
    docs = FX.order_docs(spark, SF_SMALL)
    hot = docs.withColumn("eventTimestamp", F.when(F.col("kafkaOffset") % 7 != 0, F.lit("2001-06-15 10:00:00").cast("timestamp")))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
        ST.write_store(hot.repartition(6), path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    back = ST.scan_orders(spark, path)
    assert back.count() == docs.count()
    files = back.filter("event_date is not null").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert ST.drop_expired(spark, path, "2002-01-01 00:00:00") == ["event_date=2001-06-15"]
    assert ST.scan_orders(spark, path).filter("eventTimestamp is null").count() == hot.filter("eventTimestamp is null").count()


def test_ids_are_whole_beyond_their_width(spark):
    from orderflow.functions import scalars as X
    ids = spark.createDataFrame([(1,), (9_999,), (10_000,), (123_456_789,)], "k long").select(
        X.padded(F.col("k"), 4).alias("a"), X.padded(F.col("k"), 8).alias("b")).collect()
    assert [tuple(r) for r in ids] == [("0001", "00000001"), ("9999", "00009999"), ("10000", "00010000"), ("123456789", "123456789")]


def test_every_customer_has_an_id_of_their_own(spark):
    big = "/root/testdata/sf0.1"
    docs = FX.order_docs(spark, big)
    want = spark.read.parquet(f"{big}/orders.parquet").select("o_custkey").distinct().count()
    assert docs.select("customerId").distinct().count() == want > 9_999
