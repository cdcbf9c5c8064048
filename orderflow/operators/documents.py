"""Event <-> record <-> document mapping.

All of it is per-row column logic (``from_json``/``to_json``/``transform``),
so it runs map-side with no shuffle and works the same on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.functions import scalars as X

CORRUPT = "_corrupt_record"


# ---------------------------------------------------------------------- A2
def parse_orders(df: DataFrame, value_col: str = "value", schema: T.StructType = S.ORDER_EVENT) -> DataFrame:
    """Decode the JSON value into ``event`` (a struct of ``schema``) and flag
    failures in ``parseError``.  Unknown fields are ignored; no value, an empty
    or blank one, JSON that is no object, bad syntax or a wrong-typed field is
    a failure (PERMISSIVE mode keeps the raw text).  The parsed value comes out
    of a one-element explode, so that it is parsed once however often the
    columns are used."""
    parse_schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), parse_schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    value = F.col(value_col)
    no_object = value.isNull() | ~value.rlike(r"^\s*\{")
    return (
        df.select("*", F.explode(F.array(parsed)).alias("_parsed"))
        .withColumn("parseError", F.coalesce(no_object | F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull(),
                                             F.lit(True)))
        .withColumn("event", F.when(~F.col("parseError"), F.col("_parsed").dropFields(CORRUPT)))
        .drop("_parsed")
    )


def flatten_event(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``event.*`` as top-level columns, plus the ``keep`` columns."""
    keep = keep or []
    return df.select(*keep, "event.*")


# ---------------------------------------------------------------------- A3
def event_json(df: DataFrame, fields: list[str] = S.ORDER_EVENT_FIELDS) -> Column:
    """JSON text of an event: every field written, nulls included, timestamps
    as ISO instant text (what the producer's JSON mapper emits)."""
    cols = []
    for f in fields:
        if isinstance(df.schema[f].dataType, T.TimestampType):
            cols.append(X.iso_text(F.col(f)).alias(f))
        else:
            cols.append(F.col(f))
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def to_topic_records(df: DataFrame, routing: str = "tier", lanes: int | None = None,
                     fields: list[str] = S.ORDER_EVENT_FIELDS) -> DataFrame:
    """Events -> (key, value, partition) topic records.

    ``routing='tier'``: key ``tier:customerId``, PREMIUM on lane 0.
    ``routing='priority'``: key ``priority:customerId``, priority bands.
    The lane is a column for the sink (Kafka's ``partition`` column); it is
    never used as a shuffle key, since lane 0 is hot by design.
    """
    if routing == "tier":
        key = X.partition_key(F.col("customerTier"), F.col("customerId"))
        lane = lambda k: X.tier_lane(k, lanes or S.TIER_LANES)
    elif routing == "priority":
        key = X.partition_key(F.col("priority"), F.col("customerId"))
        lane = lambda k: X.priority_lane(k, lanes or S.PRIORITY_LANES)
    else:
        raise ValueError(f"unknown routing {routing!r}")
    present = [f for f in fields if f in df.columns]
    return (
        df.select(key.alias("key"), event_json(df, present).alias("value"))
        .withColumn("partition", lane(F.col("key")))
    )


def publish_outcome(records: DataFrame, max_bytes: int = S.MAX_RECORD_BYTES) -> DataFrame:
    """Whether each topic record can be published: ``published`` is false, with
    a ``publishError``, for one without a key or lane, or larger than the topic takes."""
    error = (F.when(F.col("key").isNull(), F.lit("no key"))
             .when(F.col("partition").isNull(), F.lit("no lane"))
             .when(F.coalesce(F.octet_length("value"), F.lit(0)) > max_bytes, F.lit("record too large")))
    return records.withColumn("publishError", error).withColumn("published", F.col("publishError").isNull())


def write_orders(records: DataFrame, sink: str, fmt: str = "parquet", topic: str = S.ORDER_TOPIC,
                 options: dict | None = None, batch_id: int = 0) -> None:
    """Write topic records.  ``fmt='kafka'`` uses the Kafka sink (its
    ``partition`` column routes records); any file format writes one folder
    per batch and lane as a stand-in, and a batch that is written again
    replaces its own folder."""
    options = options or {}
    if fmt == "kafka":
        (records.select("key", "value", "partition").write.format("kafka")
         .option("topic", topic).options(**options).save())
    else:
        (records.withColumn("topic", F.lit(topic)).write.mode("overwrite")
         .partitionBy("partition").format(fmt).options(**options).save(f"{sink}/batch_id={batch_id}"))


def publish_ack(df: DataFrame) -> DataFrame:
    """The acknowledgement row of an accepted order."""
    return df.select(
        F.lit(S.PUBLISH_ACK_MESSAGE).alias("message"),
        "orderId",
        F.col("customerTier").alias("tier"),
        X.routing_label(F.col("customerTier")).alias("routing"),
    )


# ---------------------------------------------------------------------- B4
def document_columns(get, processing_status: str | Column, as_of: Column, partition: Column, offset: Column,
                     topic: Column) -> list[Column]:
    """ORDER_DOCUMENT columns from event fields (``get(name) -> Column``) and
    the record's envelope.  Null items become an empty list, a null
    retryCount 0 and a missing event time the store's clock."""
    status = processing_status if isinstance(processing_status, Column) else F.lit(processing_status)
    item = lambda i: F.struct(*[i[f.name].alias(f.name) for f in S.ORDER_ITEM.fields])
    return [
        *[get(c).alias(c) for c in ["orderId", "customerId", "customerTier", "status", "totalAmount", "currency",
                                    "region"]],
        F.coalesce(F.transform(get("items"), item), F.array().cast(T.ArrayType(S.ORDER_ITEM))).alias("items"),
        get("paymentMethod").alias("paymentMethod"), get("warehouseId").alias("warehouseId"),
        F.coalesce(get("eventTimestamp"), as_of).alias("eventTimestamp"),
        get("sourceSystem").alias("sourceSystem"),
        F.coalesce(get("retryCount"), F.lit(0)).cast("int").alias("retryCount"),
        get("lastError").alias("lastError"),
        partition.cast("int").alias("kafkaPartition"),
        offset.cast("long").alias("kafkaOffset"),
        topic.alias("kafkaTopic"),
        status.alias("processingStatus"),
    ]


def to_order_document(events: DataFrame, processing_status: str | Column, as_of: Column,
                      partition_col: str = "partition", offset_col: str = "offset",
                      topic_col: str = "topic") -> DataFrame:
    """Event rows (flattened, plus envelope columns) -> ORDER_DOCUMENT.
    ``id``/``createdAt``/``updatedAt`` are assigned by the upsert."""
    return events.select(*document_columns(F.col, processing_status, as_of, F.col(partition_col),
                                           F.col(offset_col), F.col(topic_col)))


# ---------------------------------------------------------------------- B5
def place_orders(requests: DataFrame, id_hex: int = 8, keep: list[str] | None = None) -> DataFrame:
    """Requests -> new P2 orders: fresh id, PLACED, no retries, defaults for
    source system and currency, plus the ``keep`` columns."""
    return requests.select(
        X.order_id(id_hex).alias("orderId"),
        "customerId", "customerName", "customerEmail",
        F.lit("PLACED").alias("status"),
        "priority", "region", "category", "items", "totalAmount",
        F.coalesce(F.col("currency"), F.lit(S.DEFAULT_CURRENCY)).alias("currency"),
        F.coalesce(F.col("sourceSystem"), F.lit(S.DEFAULT_SOURCE_SYSTEM)).alias("sourceSystem"),
        F.lit(0).alias("retryCount"), *(keep or []),
    )


# ------------------------------------------------------------------ A5 / A6
def stamp_dead_letters(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Parsed dead letters (``event`` struct + envelope) -> DLQ documents
    carrying the dead-letter topic's metadata, plus the ``keep`` columns."""
    ok = parsed.filter(~F.col("parseError"))
    events = ok.select("partition", "offset", "topic", "event.*", *(keep or [])).withColumns({
        "retryCount": F.lit(S.MAX_ATTEMPTS),
        "lastError": F.lit(S.DLQ_ERROR),
    })
    return events


def quarantine(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Records that do not parse: kept with the first 200 characters for the
    report and the full raw value so they can be replayed."""
    return parsed.filter(F.col("parseError")).select(
        "topic", "partition", "offset",
        F.substring(F.col(value_col), 1, S.QUARANTINE_PREFIX_CHARS).alias("rawPrefix"),
        F.col(value_col).alias("rawValue"),
    )
