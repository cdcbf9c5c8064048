"""The bucketed store: what a merge reads and rewrites, and that its order doesn't matter."""
import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators import store as ST
from orderflow.operators.buckets import BucketedStore
from orderflow.session import list_folders, scratch_path
from orderflow.sources import fixtures as FX
from orderflow.streaming import jobs as J
from orderflow.streaming.upserts import upsert_stream

from paths import SF_SMALL

LOG = "orderId string, status string, totalAmount decimal(18,2), seq long, ingestedAt timestamp"
COLS = ["id", "orderId", "status", "totalAmount", "seq", "createdAt", "updatedAt"]


def t(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def files_of(store):
    return {f.rpartition("/data/")[2] for f in store.state().inputFiles()}


def test_one_percent_reads_and_rewrites_its_buckets_only(spark):
    log = FX.deliveries(spark, SF_SMALL)
    store = BucketedStore(spark, scratch_path(spark, "test-buckets"), ["delivery", "seq"], buckets=128)
    assert len(store.merge(log.filter("delivery = 1"))) == 128
    before = files_of(store)
    batch = log.filter("delivery = 2 and kafkaOffset % 100 = 0")
    n, asked = batch.count(), store.touched(batch)
    assert 0 < len(asked) <= n < 128
    read = {f.rpartition("/data/")[2].split("/")[0] for f in store.merged(batch, asked).inputFiles() if "/data/" in f}
    assert read == {f"bucket={b}" for b in asked}
    assert store.merge(batch) == asked
    after = files_of(store)
    assert {f.split("/")[0] for f in after - before} == {f"bucket={b}" for b in asked}
    assert {f for f in before if f.split("/")[0] not in {f"bucket={b}" for b in asked}} <= after
    want = ST.upsert_orders(log.filter("delivery = 1").unionByName(batch), ["delivery", "seq"])
    assert sorted(store.read().select(want.columns).collect()) == sorted(want.collect())


def test_every_order_of_arrival_and_replays(spark):
    rows = [("O1", "PLACED", Decimal("1"), 5, t(2)), ("O1", "SHIPPED", Decimal("2"), 9, t(4)), ("O1", "OLD", Decimal("3"), 7, t(3)),
            ("O2", "PLACED", Decimal("4"), 6, t(1)), (None, "PLACED", Decimal("5"), 8, t(1))]
    want = sorted(ST.upsert_orders(spark.createDataFrame(rows, LOG), ["seq"]).select(COLS).collect(), key=str)
    orders = random.Random(3).sample(list(itertools.permutations(rows)), 4)
    for order in orders:
        store = BucketedStore(spark, scratch_path(spark, "test-orders"), ["seq"], buckets=4)
        for part in (order[:2], [order[2], order[0]], order[3:], order[:1]):
            store.merge(spark.createDataFrame(part, LOG))
        assert sorted(store.read().select(COLS).collect(), key=str) == want


def test_a_merge_that_died_leaves_nothing(spark, monkeypatch):
    store = BucketedStore(spark, scratch_path(spark, "test-died"), ["seq"], buckets=4)
    store.merge(spark.createDataFrame([("O1", "PLACED", Decimal("1"), 1, t(1))], LOG))
    before = sorted(store.read().collect())
    batch = spark.createDataFrame([("O1", "SHIPPED", Decimal("2"), 2, t(2)), ("O2", "PLACED", Decimal("1"), 3, t(2))], LOG)
    with monkeypatch.context() as m:
        m.setattr(BucketedStore, "manifest", lambda self, version=None: 1 / 0 if version == 0 else {})
        with pytest.raises(ZeroDivisionError):
            store.merge(batch)  # its rows are written, its manifest isn't
    assert store.version() == 0 and sorted(store.read().collect()) == before
    store.merge(batch)
    assert {r.orderId: r.status for r in store.read().collect()} == {"O1": "SHIPPED", "O2": "PLACED"}


def test_racing_merges_can_not_both_commit(spark, monkeypatch):
    root = scratch_path(spark, "test-race")
    a, b = (BucketedStore(spark, root, ["seq"], buckets=4) for _ in range(2))
    a.merge(spark.createDataFrame([("O1", "PLACED", Decimal("1"), 1, t(1))], LOG))
    b.merge(spark.createDataFrame([("O2", "PLACED", Decimal("1"), 2, t(1))], LOG))
    monkeypatch.setattr(a, "version", lambda: 0)  # has not seen the other's commit
    with pytest.raises(Exception, match="(?i)already exists"):
        a.merge(spark.createDataFrame([("O3", "PLACED", Decimal("1"), 3, t(1))], LOG))
    assert {r.orderId for r in b.read().collect()} == {"O1", "O2"}


def test_find_and_vacuum(spark):
    log = FX.deliveries(spark, SF_SMALL)
    store = BucketedStore(spark, scratch_path(spark, "test-find"), ["delivery", "seq"], buckets=16)
    assert store.merge(log.limit(0)) == [] and store.version() == -1
    with pytest.raises(FileNotFoundError):
        store.read()
    for k in (0, 1, 2):
        store.merge(log.filter(F.col("kafkaOffset") % 3 == k))
    ids = [r[0] for r in log.select("orderId").distinct().limit(2).collect()]
    found = store.find([*ids, "ORD-none"])
    assert {r.orderId for r in found.collect()} == set(ids)
    assert len({f.split("/bucket=")[1].split("/")[0] for f in found.inputFiles()}) <= 3
    before = sorted(store.read().collect())
    assert store.vacuum(keep=1) > 0
    assert sorted(store.read().collect()) == before
    folders = [list_folders(spark, f"{store.root}/data/{b}") for b in list_folders(spark, f"{store.root}/data")]
    assert {tuple(f) for f in folders} == {("version=2",)} and list_folders(spark, f"{store.root}/manifest") == ["version=2"]


def test_streaming_upsert_keeps_no_state(spark):
    root = scratch_path(spark, "test-upserts")
    log = FX.deliveries(spark, SF_SMALL)
    J.materialize(log, f"{root}/src", files=5)  # both deliveries of an order in any order
    store = BucketedStore(spark, f"{root}/store", ["delivery", "seq"], buckets=8)

    def run():
        return upsert_stream(J.read_files(spark, f"{root}/src", log.schema, 2), store, f"{root}/ckpt")

    q = run()
    assert all(p["stateOperators"] == [] for p in q.recentProgress) and store.version() == 2
    log.filter("delivery = 1").limit(200).coalesce(1).write.mode("append").parquet(f"{root}/src")  # delivered again, late
    run()
    want = ST.upsert_orders(log, ["delivery", "seq"])
    assert sorted(store.read().select(want.columns).collect()) == sorted(want.collect())
