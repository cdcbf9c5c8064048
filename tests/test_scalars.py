"""Scalar functions: Java hash, routing lanes, text and money helpers."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.functions import scalars as X


def one(spark, col, rows, schema="k string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


HASHES = [("", 0), ("CUST-1234567", 143746234), ("é€x", 483317), ("a😀b", 57849694),
          ("polygenelubricants", -2147483648), ("CUST-042", 1387760692), ("CUST-999", 1387769503),
          ("CUST-001", 1387760567)]


@pytest.mark.parametrize("text,expected", HASHES)
def test_java_string_hash(spark, text, expected):
    assert one(spark, X.java_string_hash("k"), [(text,)]) == [expected]


def test_abs_hash_min_value_stays_valid(spark):
    assert one(spark, X.java_abs_hash("k"), [("polygenelubricants",)]) == [2147483648]


def test_premium_goes_to_lane_0(spark):
    keys = [("PREMIUM:CUST-001",)] + [(f"PREMIUM:CUST-{i}",) for i in range(20)]
    assert set(one(spark, X.tier_lane("k"), keys)) == {0}


def test_standard_never_lane_0_and_spread(spark):
    lanes = one(spark, X.tier_lane("k"), [(f"STANDARD:CUST-{i}",) for i in range(100)])
    assert 0 not in lanes and all(1 <= x <= 3 for x in lanes)
    assert len(set(lanes[:50])) > 1


def test_tier_lane_stable_null_and_goldens(spark):
    lanes = one(spark, X.tier_lane("k"), [("STANDARD:CUST-123",)] * 10)
    assert len(set(lanes)) == 1
    assert one(spark, X.tier_lane("k"), [(None,)]) == [0]
    assert one(spark, X.tier_lane("k"), [("STANDARD:CUST-042",), ("BASIC:CUST-999",), ("X:",)]) == [2, 2, 1]


def test_priority_bands(spark):
    flash = one(spark, X.priority_lane("k"), [(f"FLASH_SALE:CUST-{i:03d}",) for i in range(20)])
    express = one(spark, X.priority_lane("k"), [(f"EXPRESS:CUST-{i:03d}",) for i in range(20)])
    std = one(spark, X.priority_lane("k"),
              [(f"STANDARD:CUST-{i:03d}",) for i in range(20)] + [("UNKNOWN:CUST-001",)])
    assert set(flash) <= {6, 7} and set(express) <= {4, 5} and set(std) <= {0, 1, 2, 3}


def test_priority_goldens(spark):
    keys = [("STANDARD:CUST-001",), ("EXPRESS:CUST-001",), ("FLASH_SALE:CUST-001",), (None,)]
    assert one(spark, X.priority_lane("k"), keys) == [3, 5, 7, 0]
    assert one(spark, X.priority_lane("k", 3), [("FLASH_SALE:CUST-001",)]) == [2]


def test_partition_key_prints_null(spark):
    df = spark.createDataFrame([("PREMIUM", "C1"), (None, "C2")], "t string, c string")
    assert [r[0] for r in df.select(X.partition_key("t", "c")).collect()] == ["PREMIUM:C1", "null:C2"]


def test_order_id_shape(spark):
    ids = [r[0] for r in spark.range(200).select(X.order_id().alias("i")).collect()]
    assert all(i.startswith("ORD-") and len(i) == 12 and i[4:] == i[4:].upper() for i in ids)
    assert len(set(ids)) == 200
    wide = spark.range(1).select(X.order_id(16)).first()[0]
    assert len(wide) == 20


def test_backoff(spark):
    got = one(spark, X.backoff_ms(F.col("a")), [(1,), (2,), (3,), (4,), (10,)], "a int")
    assert got == [2000, 4000, 8000, 16000, 30000]


def test_hour_label_and_iso(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00",), ("2024-01-15 10:30:00.123",)], "t string") \
        .select(F.col("t").cast("timestamp").alias("t"))
    rows = df.select(X.hour_label("t"), X.iso_text("t")).collect()
    assert rows[0][0] == "2024-01-15T10:00:00Z" and rows[0][1] == "2024-01-15T10:30:00Z"
    assert rows[1][1] == "2024-01-15T10:30:00.123Z"


def test_pct_matches_js_round(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5)], "c long, t long")
    assert [r[0] for r in df.select(X.pct("c", "t")).collect()] == [13, 33, 67, 0]


def test_items_total_and_count(spark):
    df = spark.createDataFrame(
        [([("P1", "a", "X", 2, Decimal("10.005")), ("P2", "b", "Y", 1, Decimal("0.50"))],), (None,)],
        "items array<struct<productId:string,productName:string,category:string,quantity:int,unitPrice:decimal(18,3)>>")
    rows = df.select(X.item_count("items"), X.items_total("items")).collect()
    assert rows[0][0] == 2 and rows[0][1] == Decimal("20.51")
    assert rows[1][0] == 0 and rows[1][1] is None
