"""Retry routing: topic / delay table and the attempt fan-out."""
from pyspark.sql import functions as F

from orderflow.operators import retry as R

def as_of():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def test_route_table(spark):
    df = spark.createDataFrame([(a, False) for a in range(1, 5)] + [(1, True)], "attempt int, ok boolean")
    rows = R.route_failures(df, "ok", "attempt", as_of()).orderBy("attempt").collect()
    assert [(r.nextTopic, r.delayMs, r.nextAttempt, r.deadLetter) for r in rows] == [
        ("orders.placed-retry-0", 2000, 2, False), ("orders.placed-retry-1", 4000, 3, False),
        ("orders.placed-retry-2", 8000, 4, False), ("orders.placed-dlt", 0, None, True)]
    assert str(rows[0].dueAt) == "2024-01-01 00:00:02"


def test_attempts_until_first_success(spark):
    recs = spark.createDataFrame([(0,), (2,), (5,)], "offset long")
    got = R.attempts_of(recs, lambda a: a <= F.col("offset")).groupBy("offset").agg(
        F.count("*").alias("n"), F.max(F.col("ok").cast("int")).alias("anyOk")).orderBy("offset").collect()
    assert [(r.offset, r.n, r.anyOk) for r in got] == [(0, 1, 1), (2, 3, 1), (5, 4, 0)]


def test_due_retries_union(spark):
    batch = spark.createDataFrame([(1, 1)], "offset long, attempt int")
    retries = spark.createDataFrame([(2, 2, "2024-01-01 00:00:02"), (3, 2, "2024-01-01 00:01:00")],
                                    "offset long, attempt int, dueAt string").withColumn(
        "dueAt", F.col("dueAt").cast("timestamp"))
    now = as_of() + F.expr("INTERVAL 5 SECONDS")
    assert sorted(r.offset for r in R.with_due_retries(batch, retries, now).collect()) == [1, 2]
