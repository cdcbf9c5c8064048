"""Aggregations: the reference's analytics goldens and edge cases."""
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow.operators import metrics as M

LC = "orderId string, customerId string, priority string, region string, category string, " \
     "totalAmount decimal(18,2), status string, createdAt timestamp"
def as_of():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def orders(spark, rows):
    full = [(f"O{i}", "C", p, r, c, Decimal(a) if a is not None else None, s, None)
            for i, (p, r, c, a, s) in enumerate(rows)]
    return spark.createDataFrame(full, LC)


def test_priority_counts(spark):
    df = orders(spark, [("EXPRESS", "NORTH", "ELECTRONICS", "5000", "PLACED"),
                        ("FLASH_SALE", "SOUTH", "FASHION", "2000", "PLACED"),
                        ("STANDARD", "EAST", "GROCERY", "500", "PLACED")])
    got = {(r.dimension, r.value): r.orders for r in M.dimension_counts(df).collect()}
    assert got[("priority", "EXPRESS")] == got[("priority", "FLASH_SALE")] == got[("priority", "STANDARD")] == 1


def test_revenue_excludes_cancelled_and_failed(spark):
    df = orders(spark, [(None, None, None, "10000", "PLACED"), (None, None, None, "5000", "CANCELLED"),
                        (None, None, None, "3000", "FAILED")])
    r = M.live_revenue(df).first()
    assert r.totalRevenue == Decimal("10000.00") and r.totalOrders == 1


def test_average_order_value(spark):
    df = orders(spark, [(None, None, None, "6000", "PLACED"), (None, None, None, "4000", "PLACED")])
    assert M.dashboard_snapshot(df, as_of()).first().avgOrderValue == Decimal("5000.00")


def test_average_zero_when_empty(spark):
    df = orders(spark, [])
    snap = M.dashboard_snapshot(df, as_of()).first()
    assert snap.avgOrderValue == Decimal("0.00") and snap.totalOrders24h == 0


def test_failed_count(spark):
    df = orders(spark, [(None, None, None, "1000", "FAILED"), (None, None, None, "2000", "FAILED")])
    assert M.failed_count(df).first().failedOrders == 2
    assert M.dashboard_snapshot(df, as_of()).first().failedOrders == 2


def test_null_status_kept_in_revenue_and_defaults(spark):
    df = orders(spark, [(None, None, None, "100", None)])
    assert M.live_revenue(df).first().totalOrders == 1
    got = {(r.dimension, r.value) for r in M.dimension_counts(df).collect()}
    assert {("status", "UNKNOWN"), ("region", "UNKNOWN"), ("priority", "STANDARD"), ("category", "OTHER")} == got


def test_sales_summary_empty_gives_no_row(spark):
    df = spark.createDataFrame([], "processingStatus string, totalAmount decimal(18,2)")
    assert M.sales_summary(df).count() == 0


def test_status_counts_include_zeros(spark):
    df = orders(spark, [(None, None, None, "1", "PLACED")])
    got = {r.status: r.orders for r in M.status_counts(df).collect()}
    assert len(got) == 9 and got["PLACED"] == 1 and got["REFUNDED"] == 0


def test_money_avg_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("10.00"), 3), (Decimal("-0.05"), 2), (Decimal("1"), 0)],
                               "t decimal(18,2), n long")
    got = [r[0] for r in df.select(M.money_avg("t", "n")).collect()]
    assert got == [Decimal("0.03"), Decimal("3.33"), Decimal("-0.03"), Decimal("0.00")]


def test_session_totals_bad_amount_counts_zero(spark):
    df = spark.createDataFrame([("PREMIUM", "10.4"), ("BASIC", "abc"), (None, "5.2")],
                               "customerTier string, totalAmount string")
    r = M.session_totals(df).first()
    assert (r.orders, r.premium, r.standard, r.revenue, r.avgOrder) == (3, 1, 2, 16, 5)
