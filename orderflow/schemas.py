"""Schemas, the money type and the fixed value lists of the order model.

Everything is declared; nothing is inferred.  Unknown JSON fields are dropped
by ``from_json`` and ISO-8601 text parses into ``TIMESTAMP`` (UTC session).
"""

from __future__ import annotations

from pyspark.sql import types as T

# One money type for every amount, price, discount and revenue.
AMOUNT = T.DecimalType(18, 2)
AMOUNT_SQL = "DECIMAL(18,2)"

# --- fixed values: must equal the reference's for right results -------------
ORDER_TOPIC = "orders.placed"
DEAD_LETTER_SUFFIX = "-dlt"
RETRY_SUFFIX = "-retry-"
MAX_ATTEMPTS = 4
BACKOFF_BASE_MS = 2000
BACKOFF_MULTIPLIER = 2.0
BACKOFF_MAX_MS = 30000
DLQ_ERROR = "Exhausted all retry attempts — moved to DLQ"
QUARANTINE_PREFIX_CHARS = 200
RETENTION_DAYS = 90
PREMIUM = "PREMIUM"
TIER_LANES = 4
PRIORITY_LANES = 8
PREMIUM_ROUTE_LABEL = "partition-0 (priority lane)"
STANDARD_ROUTE_LABEL = "standard partitions"
PUBLISH_ACK_MESSAGE = "Order accepted and queued for processing"
ORDER_ID_PREFIX = "ORD-"
DEFAULT_CURRENCY = "INR"
DEFAULT_SOURCE_SYSTEM = "API"
NOT_FOUND_MESSAGE = "Order not found: "

# P1 (wired pipeline)
TIERS = ["PREMIUM", "STANDARD", "BASIC"]
ORDER_STATUSES = ["PLACED", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"]
REGIONS = ["NORTH", "SOUTH", "EAST", "WEST", "INTERNATIONAL"]
PAYMENT_METHODS = ["UPI", "CARD", "NETBANKING", "COD", "WALLET"]
PROCESSING_STATUSES = ["SUCCESS", "FAILED", "DLQ"]

# P2 (lifecycle orders)
LIFECYCLE_STATUSES = [
    "PLACED", "PAYMENT_CONFIRMED", "PROCESSING", "SHIPPED", "OUT_FOR_DELIVERY",
    "DELIVERED", "CANCELLED", "REFUNDED", "FAILED",
]
PRIORITIES = ["STANDARD", "EXPRESS", "FLASH_SALE"]
REVENUE_EXCLUDED_STATUSES = ["CANCELLED", "FAILED"]

# null-key defaults of the running counters
UNKNOWN = "UNKNOWN"
DEFAULT_PRIORITY = "STANDARD"
DEFAULT_CATEGORY = "OTHER"

# Bean-validation default messages (English) used in error texts
MSG_NOT_BLANK = "must not be blank"
MSG_NOT_NULL = "must not be null"
MSG_MIN_AMOUNT = "must be greater than or equal to 0.01"
MIN_AMOUNT = "0.01"
# request-level messages declared on the request type
REQUEST_MESSAGES = {
    "customerId": "customerId is required",
    "customerName": "customerName is required",
    "priority": "priority is required",
    "region": "region is required",
    "category": "category is required",
    "items": "At least one item required",
    "totalAmount_min": "totalAmount must be positive",
}
# ----------------------------------------------------------------------------

# the largest record a topic takes unless it is told otherwise (Kafka's default)
MAX_RECORD_BYTES = 1_048_576

ORDER_ITEM = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPrice", AMOUNT),
])

ORDER_EVENT = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("customerTier", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("totalAmount", AMOUNT),
    T.StructField("currency", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("paymentMethod", T.StringType()),
    T.StructField("warehouseId", T.StringType()),
    T.StructField("eventTimestamp", T.TimestampType()),
    T.StructField("sourceSystem", T.StringType()),
    T.StructField("retryCount", T.IntegerType()),
    T.StructField("lastError", T.StringType()),
])

ORDER_EVENT_FIELDS = [f.name for f in ORDER_EVENT.fields]

DOCUMENT_EXTRA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("kafkaPartition", T.IntegerType()),
    T.StructField("kafkaOffset", T.LongType()),
    T.StructField("kafkaTopic", T.StringType()),
    T.StructField("processingStatus", T.StringType()),
    T.StructField("createdAt", T.TimestampType()),
    T.StructField("updatedAt", T.TimestampType()),
])

ORDER_DOCUMENT = T.StructType(ORDER_EVENT.fields + DOCUMENT_EXTRA.fields)

LIFECYCLE_ITEM = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPrice", AMOUNT),
    T.StructField("discount", AMOUNT),
])

ORDER_REQUEST = T.StructType([
    T.StructField("customerId", T.StringType()),
    T.StructField("customerName", T.StringType()),
    T.StructField("customerEmail", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("items", T.ArrayType(LIFECYCLE_ITEM)),
    T.StructField("totalAmount", AMOUNT),
    T.StructField("currency", T.StringType()),
    T.StructField("sourceSystem", T.StringType()),
])

# Envelope of one topic record (the Kafka source's columns).
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
