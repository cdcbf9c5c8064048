"""ANSI SQL (DuckDB dialect) twins of the registered queries.

Each statement re-derives its input from the raw tables with the same
fixture definitions (``FIXTURES.md``) and computes the expected result
independently of Spark.  Only the driver's correctness check uses these.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"

ORDER_DOCS = """order_docs AS (
SELECT 'ORD-' || lpad(cast(o_orderkey as string), cast(greatest(8, length(cast(o_orderkey as string))) as int), '0') AS orderId,
 'CUST-' || lpad(cast(c_custkey as string), cast(greatest(4, length(cast(c_custkey as string))) as int), '0') AS customerId,
 CASE WHEN c_custkey % 6 = 0 THEN 'PREMIUM' WHEN c_custkey % 6 <= 3 THEN 'STANDARD' ELSE 'BASIC' END AS customerTier,
 CASE o_orderkey % 5 WHEN 0 THEN 'PLACED' WHEN 1 THEN 'CONFIRMED' WHEN 2 THEN 'SHIPPED' WHEN 3 THEN 'DELIVERED' ELSE 'CANCELLED' END AS status,
 cast(o_totalprice as decimal(18,2)) AS totalAmount, 'INR' AS currency,
 CASE r_name WHEN 'EUROPE' THEN 'NORTH' WHEN 'AFRICA' THEN 'SOUTH' WHEN 'ASIA' THEN 'EAST' WHEN 'AMERICA' THEN 'WEST' ELSE 'INTERNATIONAL' END AS region,
 CASE o_orderkey % 7 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'NETBANKING' WHEN 3 THEN 'COD' WHEN 4 THEN 'WALLET' WHEN 5 THEN 'UPI' ELSE NULL END AS paymentMethod,
 CASE WHEN o_orderkey % 20 = 0 THEN 'DLQ' WHEN o_orderkey % 20 = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS processingStatus,
 cast(CASE WHEN o_orderkey % 20 = 0 THEN 4 WHEN o_orderkey % 20 = 1 THEN o_orderkey % 4 ELSE 0 END as int) AS retryCount,
 CASE substring(o_orderpriority,1,1) WHEN '1' THEN 'FLASH_SALE' WHEN '2' THEN 'EXPRESS' ELSE 'STANDARD' END AS priority,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CASE o_custkey % 5 WHEN 0 THEN 'ELECTRONICS' WHEN 1 THEN 'FASHION' WHEN 2 THEN 'GROCERY' WHEN 3 THEN 'PHARMA' ELSE 'HOME' END END AS category,
 CASE o_orderkey % 9 WHEN 0 THEN 'PLACED' WHEN 1 THEN 'PAYMENT_CONFIRMED' WHEN 2 THEN 'PROCESSING' WHEN 3 THEN 'SHIPPED' WHEN 4 THEN 'OUT_FOR_DELIVERY' WHEN 5 THEN 'DELIVERED' WHEN 6 THEN 'CANCELLED' WHEN 7 THEN 'REFUNDED' ELSE 'FAILED' END AS lifecycleStatus,
 o_orderdate + INTERVAL '1' SECOND * cast((o_orderkey * 37) % 86400 as int) AS eventTimestamp,
 o_orderkey AS kafkaOffset
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LIFECYCLE = """lifecycle AS (
SELECT orderId, customerId, lifecycleStatus AS status, priority, region, category, totalAmount, currency,
 retryCount, eventTimestamp AS createdAt, kafkaOffset FROM order_docs)"""

_ITEM_FIELDS = ("'PROD-' || cast(p_partkey as varchar)", "p_name", "p_type", "cast(l_quantity as int)",
                "cast(p_retailprice as decimal(18,2))")

ITEMS = f"""items AS (
SELECT l_orderkey,
 list(struct_pack(productId := {_ITEM_FIELDS[0]}, productName := p_name, category := p_type,
   quantity := {_ITEM_FIELDS[3]}, unitPrice := {_ITEM_FIELDS[4]}) ORDER BY {', '.join(_ITEM_FIELDS)}) AS items,
 CAST(count(*) AS INT) AS itemCount,
 sum({_ITEM_FIELDS[4]} * {_ITEM_FIELDS[3]}) AS itemsTotal
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""

# the producer's JSON of one event; needs order_docs d LEFT JOIN items i
EVENT_JSON = """CAST(to_json(struct_pack(orderId := d.orderId, customerId := d.customerId, customerTier := d.customerTier,
 status := d.status, totalAmount := d.totalAmount, currency := d.currency, region := d.region, items := i.items,
 paymentMethod := d.paymentMethod, warehouseId := NULL::VARCHAR,
 eventTimestamp := strftime(d.eventTimestamp, '%Y-%m-%dT%H:%M:%SZ'), sourceSystem := 'WEB',
 retryCount := d.retryCount, lastError := NULL::VARCHAR)) AS VARCHAR)"""


def jhash_u32(e: str) -> str:
    """Java String.hashCode as unsigned 32-bit (ASCII text)."""
    return (f"list_reduce(list_transform(string_split({e}, ''), lambda ch: unicode(ch)::BIGINT), "
            f"lambda a, c: (a * 31 + c) % 4294967296, 0::BIGINT)")


def jhash(e: str) -> str:
    u = jhash_u32(e)
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def jabs(e: str) -> str:
    u = jhash_u32(e)
    return f"(CASE WHEN {u} >= 2147483648 THEN 4294967296 - {u} ELSE {u} END)"


def tier_lane(key: str, lanes: int = 4) -> str:
    cust = f"(CASE WHEN contains({key}, ':') THEN split_part({key}, ':', 2) ELSE {key} END)"
    return (f"CAST(CASE WHEN {key} IS NULL THEN 0 WHEN starts_with({key}, 'PREMIUM:') THEN 0 "
            f"ELSE {jabs(cust)} % {lanes - 1} + 1 END AS INT)")


def priority_lane(key: str, lanes: int = 8) -> str:
    k = f"coalesce({key}, '')"
    prio = f"split_part({k}, ':', 1)"
    cust = f"(CASE WHEN contains({k}, ':') THEN substr({k}, strpos({k}, ':') + 1) ELSE {k} END)"
    h = jabs(cust)
    if lanes < 8:
        return f"CAST({h} % {lanes} AS INT)"
    return (f"CAST(CASE WHEN {prio} = 'FLASH_SALE' THEN 6 + {h} % 2 WHEN {prio} = 'EXPRESS' THEN 4 + {h} % 2 "
            f"ELSE {h} % 4 END AS INT)")


def money_avg(total: str, n: str, scale: int = 2, type_: str = "DECIMAL(18,2)") -> str:
    """total / n, HALF_UP to ``scale`` places, exactly, 0 when n = 0."""
    c = f"(CAST(({total}) * 100 AS HUGEINT) * {10 ** (scale - 2)})"
    q = (f"((abs({c}) // ({n})) + CASE WHEN 2 * (abs({c}) % ({n})) >= ({n}) THEN 1 ELSE 0 END)"
         f" * sign({c})")
    step = f"CAST(0.{'0' * (scale - 1)}1 AS DECIMAL({scale + 1},{scale}))"
    return (f"CAST(CASE WHEN ({n}) > 0 THEN CAST({q} AS DECIMAL({38 - scale - 1},0)) * {step} ELSE 0 END "
            f"AS {type_})")


def exact_avg(total: str, n: str) -> str:
    """The store's own average, which isn't rounded to cents."""
    return money_avg(total, n, 6, "DECIMAL(38,6)")


def pct(part: str, total: str) -> str:
    return f"CAST(floor(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100.0 + 0.5) AS BIGINT)"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def hour_label(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:00:00Z')"


def with_(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
