"""Hot keys: a third of all rows on one customer / one order.

Results stay whole and exact, and the plans reduce the hot key map-side
(partial aggregate / partial window limit) before any shuffle."""
import contextlib
import io

from pyspark.sql import functions as F

from orderflow.operators import lookup as L
from orderflow.operators import metrics as M
from orderflow.operators import store as ST
from orderflow.sources import fixtures as FX

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def before_exchange(p: str, marker: str) -> bool:
    """``marker`` appears below (i.e. before) the first shuffle exchange."""
    lines = p.splitlines()
    ex = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    return any(marker in ln for ln in lines[ex + 1:])


def hot_orders(spark):
    lc = FX.lifecycle_orders(FX.order_docs(spark, SF))
    return lc.withColumn("customerId", F.when(F.col("kafkaOffset") % 3 == 0, F.lit("CUST-HOT"))
                         .otherwise(F.col("customerId")))


def test_hot_customer_top_n(spark):
    lc = hot_orders(spark)
    top = L.recent_per_customer(lc, 10)
    assert before_exchange(plan(top), "WindowGroupLimit")
    hot = top.filter(F.col("customerId") == "CUST-HOT").orderBy("rank").collect()
    assert len(hot) == 10
    expected = (lc.filter(F.col("customerId") == "CUST-HOT")
                .orderBy(F.col("createdAt").desc(), "orderId").limit(10).collect())
    assert [r.orderId for r in hot] == [r.orderId for r in expected]
    per = lc.groupBy("customerId").count()
    assert top.count() == per.select(F.sum(F.least(F.col("count"), F.lit(10)))).first()[0]


def test_hot_order_upsert(spark):
    docs = FX.order_docs(spark, SF).select("orderId", "status", "totalAmount", "kafkaOffset")
    log = docs.select(
        F.when(F.col("kafkaOffset") % 3 == 0, F.lit("ORD-HOT")).otherwise(F.col("orderId")).alias("orderId"),
        "status", "totalAmount", F.col("kafkaOffset").alias("seq"),
        F.lit("2001-01-01 00:00:00").cast("timestamp").alias("ingestedAt"))
    cur = ST.upsert_orders(log, ["seq"])
    assert before_exchange(plan(cur), "WindowGroupLimit")
    hot = cur.filter(F.col("orderId") == "ORD-HOT").collect()
    max_seq = log.filter(F.col("orderId") == "ORD-HOT").agg(F.max("seq")).first()[0]
    assert len(hot) == 1 and hot[0].seq == max_seq
    assert cur.count() == log.select("orderId").distinct().count()


def test_hot_group_counters_exact(spark):
    lc = hot_orders(spark).withColumn("region", F.when(F.col("kafkaOffset") % 3 == 0, F.lit("EAST"))
                                      .otherwise(F.col("region")))
    counts = M.dimension_counts(lc)
    assert before_exchange(plan(counts), "partial_count")
    got = {r.value: r.orders for r in counts.filter(F.col("dimension") == "region").collect()}
    want = {r.region: r["count"] for r in lc.groupBy("region").count().collect()}
    assert got == want


def test_skew_join_enabled(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
