"""Validity intervals against an upsert of the log up to each time."""
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow.operators import history as HI
from orderflow.operators import store as ST

LOG = "orderId string, status string, totalAmount decimal(18,2), seq long, ingestedAt timestamp"


def t(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def log_of(spark, n=60):
    rng = random.Random(1)
    rows = [(rng.choice(["O1", "O2", "O3", "O4", None]), f"S{i}", Decimal(i), rng.randrange(1000), t(rng.randrange(12))) for i in range(n)]
    return spark.createDataFrame(list({(r[0], r[3]): r for r in rows}.values()) + [("O1", "LOST", Decimal(1), 5000, None)], LOG)


def test_every_time_equals_the_upsert_up_to_it(spark):
    log = log_of(spark)
    intervals = HI.validity(log, ["seq"]).cache()
    for h in range(-1, 13):
        at = F.lit(t(h))
        want = ST.upsert_orders(log.where(F.col("ingestedAt") <= at), ["seq"])
        got = HI.orders_as_of(intervals, at).select(want.columns)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), h
    assert intervals.where("validTo <= validFrom").count() == 0


def test_moments_get_the_version_of_their_time(spark):
    log = log_of(spark)
    intervals = HI.validity(log, ["seq"])
    moments = spark.createDataFrame([(o, t(h)) for o in ("O1", "O2", "none") for h in range(-1, 13)], "orderId string, at timestamp")
    got = {(r.orderId, r.at): r.status for r in HI.versions_at(moments, intervals).collect()}
    assert len(got) == 42 and all(got["none", t(h)] is None for h in range(-1, 13))
    for h in (-1, 0, 5, 12):
        state = {r.orderId: r.status for r in ST.upsert_orders(log.where(F.col("ingestedAt") <= F.lit(t(h))), ["seq"]).collect()}
        assert all(got[o, t(h)] == state.get(o) for o in ("O1", "O2"))


def test_empty_log(spark):
    assert HI.validity(spark.createDataFrame([], LOG), ["seq"]).count() == 0
