"""JSON round trip, document mapping, order placement, dead letters."""
import json
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.operators import documents as D
from orderflow.operators import validate as V

GOOD = {"orderId": "ORD-1", "customerId": "CUST-001", "customerTier": "PREMIUM", "status": "PLACED",
        "totalAmount": 1499.99, "currency": "INR", "region": "NORTH",
        "items": [{"productId": "P1", "productName": "Phone", "category": "ELECTRONICS", "quantity": 1,
                   "unitPrice": 1499.99}],
        "paymentMethod": "UPI", "eventTimestamp": "2024-01-15T10:30:00Z", "unknownField": 1}


def envelope(spark, values):
    rows = [("k", v, S.ORDER_TOPIC, 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, S.ENVELOPE)


def test_parse_good_bad_and_wrong_type(spark):
    bad_type = dict(GOOD, totalAmount="lots")
    df = D.parse_orders(envelope(spark, [json.dumps(GOOD), '{"orderId": "ORD-2", ', json.dumps(bad_type), None]))
    rows = df.orderBy("offset").collect()
    assert [r.parseError for r in rows] == [False, True, True, True]
    ev = rows[0].event
    assert ev.orderId == "ORD-1" and ev.totalAmount == Decimal("1499.99") and len(ev.items) == 1
    assert str(ev.eventTimestamp) == "2024-01-15 10:30:00"


def test_round_trip_topic_records(spark):
    parsed = D.parse_orders(envelope(spark, [json.dumps(GOOD)]))
    events = D.flatten_event(parsed)
    rec = D.to_topic_records(events).first()
    assert rec.key == "PREMIUM:CUST-001" and rec.partition == 0
    back = json.loads(rec.value)
    assert back["eventTimestamp"] == "2024-01-15T10:30:00Z" and back["lastError"] is None
    assert "unknownField" not in back


def test_document_defaults(spark):
    ev = dict(GOOD, items=None, eventTimestamp=None)
    parsed = D.parse_orders(envelope(spark, [json.dumps(ev)]))
    doc = D.to_order_document(D.flatten_event(parsed, ["partition", "offset", "topic"]), "SUCCESS",
                              F.lit("2024-02-01 00:00:00").cast("timestamp")).first()
    assert doc.items == [] and doc.retryCount == 0 and str(doc.eventTimestamp) == "2024-02-01 00:00:00"
    assert doc.kafkaTopic == S.ORDER_TOPIC and doc.processingStatus == "SUCCESS"


def test_dead_letters_stamped_and_quarantined(spark):
    parsed = D.parse_orders(envelope(spark, [json.dumps(GOOD), "x" * 500]))
    stamped = D.stamp_dead_letters(parsed).first()
    assert stamped.retryCount == 4 and stamped.lastError == S.DLQ_ERROR
    q = D.quarantine(parsed).first()
    assert len(q.rawPrefix) == 200 and len(q.rawValue) == 500


def test_place_orders_defaults(spark):
    req = spark.createDataFrame([
        ("C1", "Rahul", "r@x", "EXPRESS", "NORTH", "ELECTRONICS",
         [("PROD-001", "Phone", "SKU", 1, Decimal("79999"), Decimal("0"))], Decimal("79999"), "INR", "WEB"),
        ("C2", "Asha", None, "STANDARD", "EAST", "HOME",
         [("PROD-002", "Lamp", "SKU", 1, Decimal("10"), Decimal("0"))], Decimal("10"), None, None),
    ], S.ORDER_REQUEST)
    rows = D.place_orders(req).orderBy("customerId").collect()
    assert all(r.orderId.startswith("ORD-") and r.status == "PLACED" and r.retryCount == 0 for r in rows)
    assert rows[0].sourceSystem == "WEB" and rows[1].sourceSystem == "API" and rows[1].currency == "INR"
    assert rows[0].orderId != rows[1].orderId


def test_validation_messages(spark):
    df = spark.createDataFrame([("O1", " ", "T", "S", None, "INR", "R"), ("O2", "C", "T", "S", Decimal("0"), "", "R"),
                                ("O3", "C", "T", "S", Decimal("5"), "INR", "R")],
                               "orderId string, customerId string, customerTier string, status string, "
                               "totalAmount decimal(18,2), currency string, region string")
    rows = {r.orderId: r for r in V.validate_events(df).collect()}
    assert rows["O1"].errorText == "customerId: must not be blank, totalAmount: must not be null"
    assert rows["O2"].errorText == ("totalAmount: must be greater than or equal to 0.01, "
                                    "currency: must not be blank")
    assert rows["O3"].isValid and rows["O3"].errorText is None
    ok, bad = V.split_valid(V.validate_events(df))
    assert ok.count() == 1 and bad.count() == 2
