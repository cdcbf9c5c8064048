"""Upsert (replay, out-of-order), retention, lookups and paging."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators import lookup as L
from orderflow.operators import store as ST

LOG = "orderId string, status string, totalAmount decimal(18,2), seq long, ingestedAt timestamp"


def t(h):
    return dt.datetime(2024, 1, 1, h)


def test_last_arrival_wins_and_keeps_first_created(spark):
    log = spark.createDataFrame([("O1", "PLACED", Decimal("1"), 1, t(1)), ("O1", "SHIPPED", Decimal("2"), 2, t(2)),
                                 ("O2", "PLACED", Decimal("3"), 3, t(3))], LOG)
    cur = {r.orderId: r for r in ST.upsert_orders(log, ["seq"]).collect()}
    assert cur["O1"].status == "SHIPPED" and cur["O1"].createdAt == t(1) and cur["O1"].updatedAt == t(2)
    assert len(cur) == 2


def test_replay_is_idempotent(spark):
    batch = [("O1", "PLACED", Decimal("1"), 1, t(1)), ("O2", "PLACED", Decimal("3"), 2, t(1))]
    once = ST.upsert_orders(spark.createDataFrame(batch, LOG), ["seq"])
    twice = ST.upsert_orders(spark.createDataFrame(batch + batch, LOG), ["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_out_of_order_arrival_is_last_arrival_not_event_time(spark):
    # a retried old event that arrives last overwrites the newer one
    log = spark.createDataFrame([("O1", "SHIPPED", Decimal("2"), 1, t(1)), ("O1", "PLACED", Decimal("1"), 2, t(2))],
                                LOG)
    assert ST.upsert_orders(log, ["seq"]).first().status == "PLACED"


def test_incremental_merge_equals_full(spark):
    b1 = [("O1", "PLACED", Decimal("1"), 1, t(1)), ("O2", "PLACED", Decimal("2"), 2, t(1))]
    b2 = [("O1", "DELIVERED", Decimal("1"), 3, t(5)), ("O3", "PLACED", Decimal("3"), 4, t(5))]
    full = ST.upsert_orders(spark.createDataFrame(b1 + b2, LOG), ["seq"])
    state = ST.upsert_orders(spark.createDataFrame(b1, LOG), ["seq"], keep_state=True)
    merged = ST.merge_into_store(state, spark.createDataFrame(b2, LOG), ["seq"])
    cols = ["id", "orderId", "status", "totalAmount", "seq", "createdAt", "updatedAt"]
    assert sorted(full.select(cols).collect()) == sorted(merged.select(cols).collect())


DOCS = "orderId string, customerId string, customerTier string, status string, region string, eventTimestamp timestamp"


@pytest.fixture
def docs(spark):
    rows = [(f"O{i:02d}", f"C{i % 3}", "PREMIUM" if i % 2 else "BASIC", "SHIPPED" if i % 4 else "PLACED",
             "WEST" if i < 10 else "EAST", t(i)) for i in range(24)]
    return spark.createDataFrame(rows, DOCS)


def test_paging_newest_first(docs):
    p0 = [r.orderId for r in L.page_orders(docs, page=0, size=5).collect()]
    p1 = [r.orderId for r in L.page_orders(docs, page=1, size=5).collect()]
    assert p0 == ["O23", "O22", "O21", "O20", "O19"] and p1[0] == "O18"
    info = L.page_info(docs, 5).first()
    assert info.totalElements == 24 and info.totalPages == 5


def test_between_exclusive_vs_inclusive(docs):
    ex = L.orders_between(docs, "2024-01-01 02:00:00", "2024-01-01 05:00:00", size=50)
    inc = L.orders_in_range(docs, "2024-01-01 02:00:00", "2024-01-01 05:00:00", ts_col="eventTimestamp")
    assert ex.count() == 2 and inc.count() == 4


def test_search_precedence(docs):
    got = L.search_orders(docs, region="WEST", tier="PREMIUM", size=50)
    assert {r.region for r in got.collect()} == {"WEST"} and got.count() == 10
    only_from = L.search_orders(docs, from_="2024-01-01 02:00:00", size=50)
    assert only_from.count() == 24


def test_enum_checks_and_not_found(spark, docs):
    with pytest.raises(ValueError):
        L.lifecycle_by_status(docs, "bogus")
    with pytest.raises(LookupError, match="Order not found: NOPE"):
        L.require_order(docs, "NOPE")


def test_recent_per_customer(docs):
    r = L.recent_per_customer(docs, 2, ts_col="eventTimestamp")
    assert r.count() == 6 and r.filter(F.col("rank") > 2).count() == 0


def test_retention_keeps_recent_and_undated(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2023, 1, 1)), ("c", None)],
                               "orderId string, eventTimestamp timestamp")
    kept = ST.apply_retention(df, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    assert sorted(r.orderId for r in kept.collect()) == ["a", "c"]


def test_orders_exist(spark, docs):
    ids = spark.createDataFrame([("O01",), ("ZZZ",)], "orderId string")
    got = {r.orderId: r.exists for r in L.orders_exist(ids, docs).collect()}
    assert got == {"O01": True, "ZZZ": False}


def test_compaction_versions_and_incremental_merge(spark):
    from orderflow.session import scratch_path
    root = scratch_path(spark, "test-compact")
    b1 = [("O1", "PLACED", Decimal("1"), 1, t(1)), ("O2", "PLACED", Decimal("2"), 2, t(1))]
    b2 = [("O1", "DELIVERED", Decimal("1"), 3, t(5)), ("O3", "PLACED", Decimal("3"), 4, t(5))]
    v0 = ST.compact_store(spark, ST.upsert_orders(spark.createDataFrame(b1, LOG), ["seq"], keep_state=True), root)
    assert v0.endswith("version=0") and ST.latest_version(spark, root) == 0
    merged = ST.merge_into_store(ST.read_snapshot(spark, root), spark.createDataFrame(b2, LOG), ["seq"])
    v1 = ST.compact_store(spark, merged, root)
    assert v1.endswith("version=1")
    snap = {r.orderId: r for r in ST.read_snapshot(spark, root).collect()}
    assert snap["O1"].status == "DELIVERED" and snap["O1"].createdAt == t(1) and len(snap) == 3


def test_merge_equals_batch_for_every_order_of_arrival(spark):
    import itertools
    rows = [("O1", "PLACED", Decimal("1"), 5, t(2)), ("O1", "SHIPPED", Decimal("2"), 9, t(4)), ("O1", "OLD", Decimal("3"), 7, t(3)),
            ("O2", "PLACED", Decimal("4"), 6, t(1))]
    cols = ["id", "orderId", "status", "totalAmount", "seq", "createdAt", "updatedAt"]
    want = sorted(ST.upsert_orders(spark.createDataFrame(rows, LOG), ["seq"]).select(cols).collect())
    for order in itertools.permutations(rows):
        state = ST.upsert_orders(spark.createDataFrame(order[:2], LOG), ["seq"], keep_state=True)
        state = ST.merge_into_store(state, spark.createDataFrame([order[2], order[0]], LOG), ["seq"])  # one replayed
        state = ST.merge_into_store(state, spark.createDataFrame([order[3]], LOG), ["seq"])
        assert sorted(state.select(cols).collect()) == want
