"""Pages by position and rolling windows from partials, against the plain operators."""
import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from orderflow.operators import lookup as L
from orderflow.operators import metrics as M
from orderflow.operators import pages as PG
from orderflow.operators import rollups as RU
from orderflow.operators import store as ST
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX

from paths import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "test-pages")
    docs = FX.order_docs(spark, SF_SMALL).withColumn("eventTimestamp", F.when(F.col("kafkaOffset") % 40 != 0, F.col("eventTimestamp")))
    ST.write_store(docs, f"{path}/store", grain="month")
    store = spark.read.parquet(f"{path}/store")
    PG.write_directory(spark, store, f"{path}/directory")
    return store, spark.read.parquet(f"{path}/directory")


def folders_read(df):
    """Folders that the executed scan read."""
    df.collect()
    files = re.findall(r"event_month=([^/]+)/", " ".join(df.select("*", F.input_file_name().alias("f")).select("f").distinct().toPandas()["f"]))
    return set(files)


@pytest.mark.parametrize(("page", "size"), [(0, 20), (3, 7), (50, 20), (73, 20), (74, 20), (75, 20), (1000, 20), (0, 5000), (1, 1499)])
def test_pages_equal_offset_and_limit(spark, stored, page, size):
    store, directory = stored
    want = L.page_orders(store, "eventTimestamp", page, size).select("orderId").collect()
    got = PG.page_by_position(store, directory, page, size).select("orderId").collect()
    assert got == want


def test_a_deep_page_prunes_folders(spark, stored):
    store, directory = stored
    df = PG.page_by_position(store, directory, 60, 10)
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain(mode="formatted")
    assert re.search(r"PartitionFilters: .*event_month.*>=.*event_month.*<=", text.getvalue())
    months = {r[0] for r in df.select("event_month").collect()}
    scanned = store.where(F.col("event_month").between(min(months), max(months))).select("event_month").distinct().count()
    assert scanned <= 2


def test_seek_goes_through_all_rows(spark, stored):
    store, _ = stored
    want = [r[0] for r in L.page_orders(store, "eventTimestamp", 0, 5000).select("orderId").collect()]
    rows = L.page_orders(store, "eventTimestamp", 0, 400).select("orderId", "eventTimestamp").collect()
    got = [r[0] for r in rows]
    while rows:
        rows = PG.page_after(store, rows[-1]["eventTimestamp"], rows[-1]["orderId"], 400).select("orderId", "eventTimestamp").collect()
        got += [r[0] for r in rows]
    assert got == want


def test_pages_of_an_empty_store_and_bad_arguments(spark, stored):
    store, directory = stored
    assert PG.page_by_position(store.where("false"), directory.where("false"), 0, 5).count() == 0
    with pytest.raises(ValueError):
        PG.page_by_position(store, directory, -1, 5)


@pytest.fixture(scope="module")
def orders(spark):
    """Lifecycle orders as written by day, with their partials of three batches."""
    path = scratch_path(spark, "test-rollups")
    rows = FX.lifecycle_orders(FX.order_docs(spark, SF_SMALL)).withColumns({
        "createdAt": F.when(F.col("kafkaOffset") % 50 != 0, F.col("createdAt")),
        "status": F.when(F.col("kafkaOffset") % 41 != 0, F.col("status")),
        "totalAmount": F.when(F.col("kafkaOffset") % 43 != 0, F.col("totalAmount"))})
    ST.write_store(rows, f"{path}/store", ts_col="createdAt", grain="month")
    store = spark.read.parquet(f"{path}/store")
    for k in range(3):
        RU.write_partials(RU.hourly_partials(store.where(F.col("kafkaOffset") % 3 == k)), f"{path}/partials", k)
    return store, RU.read_partials(spark, f"{path}/partials")


@pytest.mark.parametrize("as_of", ["2001-08-02 00:00:00", "1998-03-04 05:06:07.5", "1998-03-04 05:00:00", "1990-01-01 00:00:00", "1996-06-30 23:59:59.999"])
@pytest.mark.parametrize("hours", [1, 24, 24 * 365])
def test_resync_equals_the_full_scan(spark, orders, as_of, hours):
    store, partials = orders
    at = F.lit(as_of).cast("timestamp")
    assert RU.resync(partials, store, at, hours).collect() == M.resync(store, at, hours).collect()


@pytest.mark.parametrize("since", ["2001-06-01 00:00:00", "1998-03-04 05:06:07.5", "1990-01-01 00:00:00", "2030-01-01 00:00:01"])
def test_hourly_stats_equal_the_full_scan(spark, orders, since):
    store, partials = orders
    at = F.lit(since).cast("timestamp")
    assert RU.hourly_stats(partials, store, at).collect() == M.hourly_stats(store, at).collect()


def test_the_edges_are_all_that_is_read(spark, orders):
    store, partials = orders
    with contextlib.redirect_stdout(io.StringIO()) as text:
        RU.resync(partials, store, F.lit("1998-03-04 05:06:07").cast("timestamp")).explain(mode="formatted")
    scans = [b for b in text.getvalue().split("\n\n") if "Scan parquet" in b.split("\n")[0] and "event_month" in b]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(event_month" in b and "PushedFilters: [IsNotNull(createdAt)" in b for b in scans)


def test_changes_are_additive(spark, orders):
    store, _ = orders
    before = store.where("kafkaOffset % 4 < 3")
    after = store.where("kafkaOffset % 4 > 0").withColumn("status", F.when(F.col("kafkaOffset") % 5 == 0, "SHIPPED").otherwise(F.col("status")))
    total = RU.folded(RU.hourly_partials(before).unionByName(RU.change(before, after)))
    key = lambda r: str(tuple(r))
    assert sorted(total.collect(), key=key) == sorted(RU.folded(RU.hourly_partials(after)).collect(), key=key)
    assert RU.change(before, before).count() == 0
