"""Every registered batch query against its DuckDB twin (small scale)."""
import pytest

import __spark_entry__ as E

from paths import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
# results that are sorted: by these columns their rows must come in the order of the SQL
ORDERED = {
    "regional_sales": ["region"], "tier_distribution": ["customerTier"], "top_categories": ["category"], "hourly_stats": ["hour"],
    "hourly_chart": ["hour"], "region_share": ["region"], "payment_share": ["paymentMethod"], "recent_feed": ["arrival"],
    **{k: ["orderId"] for k in (
        "page_orders", "scan_orders", "orders_by_status", "lifecycle_by_status", "status_history", "orders_by_customer",
        "orders_by_region", "orders_by_tier", "orders_between", "orders_in_range_paged", "region_priority", "search_orders",
        "search_by_status", "search_by_customer", "search_by_tier", "search_between", "search_one_end", "search_all", "customer_top10")},
}


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def canon(rows, cols):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import digest
    return digest(rows, cols)[0]


@pytest.mark.parametrize("key", [k for k in sorted(E.oracle_sql()) if not k.endswith("_stream")
                                 and k != "resync_job"])
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(srows, df.columns) == canon(drows, dcols)
    for col in ORDERED.get(key, ()):
        assert [r[df.columns.index(col)] for r in srows] == [r[dcols.index(col)] for r in drows]


def test_entry_smoke(spark):
    assert E.entry(spark).count() == 1
