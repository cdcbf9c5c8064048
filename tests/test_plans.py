"""Plan shape: pushdown, no cartesian products, map-side limits, one scan."""
import contextlib
import io

import pytest

import __spark_entry__ as E
from orderflow.operators import lookup as L
from orderflow.session import scratch_path
from orderflow.sources import fixtures as FX

from paths import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


BATCH_KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", [k for k in BATCH_KEYS if not k.endswith("_stream") and k != "resync_job"])
def test_no_cartesian_or_nested_loop(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_lookup_filter_reaches_parquet(spark):
    path = scratch_path(spark, "plan-store")
    FX.order_docs(spark, SF_SMALL).write.parquet(path)
    store = spark.read.parquet(path)
    p = plan(L.orders_by_status(store, "SHIPPED", 0, 20))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,SHIPPED)]" in p
    assert "TakeOrderedAndProject" in p


def test_top_n_per_customer_limited_before_shuffle(spark):
    p = plan(E.queries()["recent_per_customer"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize(("key", "want"), [
    ("order_by_id", "EqualTo(orderId,ORD-00000042)"), ("orders_by_customer", "EqualTo(customerId,CUST-0010)"),
    ("orders_by_status", "EqualTo(status,SHIPPED)"), ("orders_by_region", "EqualTo(region,EAST)"),
    ("orders_by_tier", "EqualTo(customerTier,PREMIUM)"), ("lifecycle_by_status", "EqualTo(lifecycleStatus,DELIVERED)"),
    ("status_history", "EqualTo(lifecycleStatus,REFUNDED)"), ("region_priority", "EqualTo(priority,EXPRESS)"),
    ("dlq_orders", "EqualTo(processingStatus,DLQ)"), ("failed_orders", "GreaterThan(retryCount,0)"),
    ("customer_top10", "EqualTo(customerId,CUST-0010)"), ("search_orders", "EqualTo(region,WEST)"),
    ("orders_between", "event_month"), ("orders_in_range", "event_month"), ("orders_in_range_paged", "event_month"),
    ("status_in_range", "event_month"), ("search_between", "event_month")])
def test_registered_lookups_prune_their_scan(spark, key, want):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "SortMergeJoin" not in p and "HashJoin" not in p
    kind = "PartitionFilters" if want == "event_month" else "PushedFilters"
    assert any(kind in line and want in line for line in p.splitlines())


def test_upsert_reads_and_shuffles_the_log_once(spark):
    from orderflow.operators import store as ST
    path = scratch_path(spark, "plan-upsert")
    FX.deliveries(spark, SF_SMALL).write.parquet(path)
    p = plan(ST.upsert_orders(spark.read.parquet(path), ["delivery", "seq"], keep_state=True))
    tree = p.split("\n\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1
    # partial before the exchange: an order redelivered often sends one row a map task
    assert tree.count("SortAggregate") == 2 and "Join" not in tree and "Window" not in tree


def test_values_are_parsed_once(spark):
    p = plan(E.queries()["order_documents"](spark, SF_SMALL))
    assert p.count("from_json") <= 2  # the generator's line and its arguments


def test_store_report_single_scan(spark):
    p = plan(E.queries()["store_report"](spark, SF_SMALL))
    scans = [ln for ln in p.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert len(scans) == 4  # orders, customer, nation, region: each read once
    assert "Expand" in p  # grouping sets, one pass
