"""Order-shaped views derived from the TPC-H-style test tables.

The reference ships no data, so every input is derived from the given tables
(``FIXTURES.md``).  All views are plain DataFrame plans: Catalyst prunes the
scans to the columns each query touches and pushes its filters down.
Nothing is broadcast by hint; the small dimension tables (nation, region) go
through Spark's own size check (``autoBroadcastJoinThreshold``) and the
customer join falls back to a shuffle join when the table is large, with AQE
splitting a skewed customer key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import scalars as X
from orderflow.operators import documents as D

# The clock every registered query uses, so results are deterministic.
AS_OF = "2001-08-02 00:00:00"
MALFORMED_EVERY = 101


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_of(spark: SparkSession | None = None) -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _case(c: Column, mapping: list[tuple[object, str | None]], default: str | None) -> Column:
    expr = None
    for k, v in mapping:
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def _region_of(r_name: Column) -> Column:
    return _case(r_name, [("EUROPE", "NORTH"), ("AFRICA", "SOUTH"), ("ASIA", "EAST"), ("AMERICA", "WEST")],
                 "INTERNATIONAL")


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One P1 order document per TPC-H order (plus the P2 columns)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # orders x customer first: both grow with the data, so Spark's size check
    # picks a broadcast only while customer is small and a sort-merge join
    # beyond; the nation/region dimension (25 and 5 rows) joins last.
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = oc.join(geo, oc.c_nationkey == geo.n_nationkey)

    k = F.col("o_orderkey")
    ck = F.col("c_custkey")
    k20 = k % 20
    return j.select(
        F.concat(F.lit("ORD-"), X.padded(k, 8)).alias("orderId"),
        F.concat(F.lit("CUST-"), X.padded(ck, 4)).alias("customerId"),
        F.when(ck % 6 == 0, "PREMIUM").when(ck % 6 <= 3, "STANDARD").otherwise("BASIC").alias("customerTier"),
        _case(k % 5, [(0, "PLACED"), (1, "CONFIRMED"), (2, "SHIPPED"), (3, "DELIVERED")], "CANCELLED")
        .alias("status"),
        F.col("o_totalprice").cast(S.AMOUNT).alias("totalAmount"),
        F.lit(S.DEFAULT_CURRENCY).alias("currency"),
        _region_of(F.col("r_name")).alias("region"),
        _case(k % 7, [(0, "UPI"), (1, "CARD"), (2, "NETBANKING"), (3, "COD"), (4, "WALLET"), (5, "UPI")], None)
        .alias("paymentMethod"),
        F.when(k20 == 0, "DLQ").when(k20 == 1, "FAILED").otherwise("SUCCESS").alias("processingStatus"),
        F.when(k20 == 0, 4).when(k20 == 1, k % 4).otherwise(0).cast("int").alias("retryCount"),
        _case(F.substring("o_orderpriority", 1, 1), [("1", "FLASH_SALE"), ("2", "EXPRESS")], "STANDARD")
        .alias("priority"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
            _case(F.col("o_custkey") % 5,
                  [(0, "ELECTRONICS"), (1, "FASHION"), (2, "GROCERY"), (3, "PHARMA")], "HOME")
        ).alias("category"),
        _case(k % 9, [(0, "PLACED"), (1, "PAYMENT_CONFIRMED"), (2, "PROCESSING"), (3, "SHIPPED"),
                      (4, "OUT_FOR_DELIVERY"), (5, "DELIVERED"), (6, "CANCELLED"), (7, "REFUNDED")], "FAILED")
        .alias("lifecycleStatus"),
        (F.col("o_orderdate") + F.make_interval(secs=((k * 37) % 86400).cast("int")))
        .cast("timestamp").alias("eventTimestamp"),
        k.alias("kafkaOffset"),
    )


def lifecycle_orders(docs: DataFrame) -> DataFrame:
    """P2 reading of the same orders: lifecycle status and ``createdAt``."""
    return docs.select(
        "orderId", "customerId", F.col("lifecycleStatus").alias("status"), "priority", "region",
        "category", "totalAmount", "currency", "retryCount", F.col("eventTimestamp").alias("createdAt"),
        "kafkaOffset", *[c for c in ("event_date", "event_month") if c in docs.columns],
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per order: (orderkey, items ARRAY<ORDER_ITEM>) sorted by all fields.

    Line items of one order are bounded (a few per order), so the per-order
    list is a small nested value, built after a partial aggregation.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    item = F.struct(
        F.concat(F.lit("PROD-"), F.col("p_partkey").cast("string")).alias("productId"),
        F.col("p_name").alias("productName"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast(S.AMOUNT).alias("unitPrice"),
    )
    return (
        li.join(p, li.l_partkey == p.p_partkey)
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
    )


def order_events(spark: SparkSession, sf_dir: str, with_items: bool = True) -> DataFrame:
    """P1 ``ORDER_EVENT`` rows (schema order) plus the routing columns."""
    docs = order_docs(spark, sf_dir)
    if with_items:
        items = order_items(spark, sf_dir)
        docs = docs.join(items, docs.kafkaOffset == items.l_orderkey, "left")
    else:
        docs = docs.withColumn("items", F.lit(None).cast(S.ORDER_EVENT["items"].dataType))
    return docs.select(
        "orderId", "customerId", "customerTier", "status", "totalAmount", "currency", "region", "items",
        "paymentMethod", F.lit(None).cast("string").alias("warehouseId"), "eventTimestamp",
        F.lit("WEB").alias("sourceSystem"), "retryCount", F.lit(None).cast("string").alias("lastError"),
        "kafkaOffset", "processingStatus",
    )


def topic_log(spark: SparkSession, sf_dir: str, topic: str = S.ORDER_TOPIC) -> DataFrame:
    """Order events as topic records (key, value, topic, partition, offset,
    timestamp).  Every 101st record is malformed: cut in half, empty, blank,
    a JSON null, list or number, or no value at all, in turn."""
    ev = order_events(spark, sf_dir)
    key = X.partition_key(F.col("customerTier"), F.col("customerId"))
    value = D.event_json(ev)
    kind = F.floor(F.col("offset") / MALFORMED_EVERY) % 7
    bad = _case(kind, [(1, ""), (2, "  "), (3, "null"), (4, "[]"), (5, "123")], None)
    bad = F.when(kind == 0, F.expr("substring(v, 1, length(v) div 2)")).otherwise(bad)
    return (
        ev.select(key.alias("key"), value.alias("v"), F.col("kafkaOffset").alias("offset"),
                  F.col("eventTimestamp").alias("timestamp"))
        .select(
            "key",
            F.when(F.col("offset") % MALFORMED_EVERY == 0, bad).otherwise(F.col("v")).alias("value"),
            F.lit(topic).alias("topic"),
            X.tier_lane(F.col("key")).alias("partition"),
            "offset",
            "timestamp",
        )
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert input: every order delivered once as PLACED; every 10th again
    later as CANCELLED with amount + 1.  Arrival order is (``delivery``,
    ``seq``): all first deliveries, then all second ones; ``ingestedAt`` is
    the store's clock at arrival.  One scan: each order row emits its one or
    two deliveries."""
    docs = order_docs(spark, sf_dir)
    k = F.col("kafkaOffset")
    first = F.struct(F.lit("PLACED").alias("status"), F.col("totalAmount").alias("totalAmount"),
                     F.lit(1).alias("delivery"), F.col("eventTimestamp").alias("ingestedAt"))
    again = F.struct(F.lit("CANCELLED").alias("status"), (F.col("totalAmount") + 1).cast(S.AMOUNT).alias("totalAmount"),
                     F.lit(2).alias("delivery"),
                     (F.col("eventTimestamp") + F.expr("INTERVAL 1 HOUR")).alias("ingestedAt"))
    arrivals = F.filter(F.array(first, F.when(k % 10 == 0, again)), lambda d: d.isNotNull())
    return docs.select("orderId", "customerId", "customerTier", "region", "eventTimestamp", "kafkaOffset",
                       F.explode(arrivals).alias("d")).select(
        "orderId", "customerId", "customerTier", "d.totalAmount", "region", "eventTimestamp", "kafkaOffset",
        "d.status", "d.delivery", F.col("kafkaOffset").alias("seq"), "d.ingestedAt")


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with planted rule violations for validation."""
    docs = order_docs(spark, sf_dir)
    k = F.col("kafkaOffset")
    return docs.select(
        "orderId",
        F.when(k % 13 == 0, F.lit(" ")).otherwise(F.col("customerId")).alias("customerId"),
        "customerTier", "status",
        F.when(k % 17 == 0, F.lit(0).cast(S.AMOUNT))
        .when(k % 19 == 0, F.lit(None).cast(S.AMOUNT))
        .otherwise(F.col("totalAmount")).alias("totalAmount"),
        "currency", "region", "paymentMethod", "eventTimestamp", "kafkaOffset",
    )


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 order requests (the input of ``place_orders``) with the same planted
    faults as ``faulty_orders`` plus missing items / category / source."""
    docs = order_docs(spark, sf_dir)
    items = order_items(spark, sf_dir)
    k = F.col("kafkaOffset")
    req_items = F.transform(
        F.col("items"),
        lambda i: F.struct(
            i["productId"].alias("productId"), i["productName"].alias("productName"),
            F.concat(F.lit("SKU-"), i["productId"]).alias("sku"), i["quantity"].alias("quantity"),
            i["unitPrice"].alias("unitPrice"), F.lit(0).cast(S.AMOUNT).alias("discount")),
    )
    j = docs.join(items, docs.kafkaOffset == items.l_orderkey, "left")
    return j.select(
        F.col("orderId").alias("requestId"),
        F.when(k % 13 == 0, F.lit(" ")).otherwise(F.col("customerId")).alias("customerId"),
        F.concat(F.lit("Customer "), F.col("customerId")).alias("customerName"),
        F.lit(None).cast("string").alias("customerEmail"),
        "priority", "region", "category",
        req_items.alias("items"),
        F.when(k % 17 == 0, F.lit(0).cast(S.AMOUNT))
        .when(k % 19 == 0, F.lit(None).cast(S.AMOUNT))
        .otherwise(F.col("totalAmount")).alias("totalAmount"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit(S.DEFAULT_CURRENCY)).alias("currency"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("WEB")).alias("sourceSystem"),
        "kafkaOffset",
    )


def flaky_failures(attempt_col: str = "attempt", offset_col: str = "offset") -> Column:
    """The planted transient failure of the retry fixture: a record fails while
    ``offset % 50 < 6`` and its attempt is ``<= offset % 50``."""
    m = F.col(offset_col) % 50
    return (m < 6) & (F.col(attempt_col) <= m)
