"""Non-blocking retry routing (I2, I3, G1) as column logic.

A failed record on attempt k < 4 goes to ``<topic>-retry-(k-1)`` after an
exponential delay (2 s, 4 s, 8 s, capped at 30 s); a failure on attempt 4 goes
to ``<topic>-dlt``.  The routing is per-row, so it is tested in batch and used
unchanged inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S
from orderflow.functions import scalars as X


def next_topic(attempt: Column, topic: Column, max_attempts: int = S.MAX_ATTEMPTS) -> Column:
    return F.when(attempt < max_attempts,
                  F.concat(topic, F.lit(S.RETRY_SUFFIX), (attempt - 1).cast("string"))
                  ).otherwise(F.concat(topic, F.lit(S.DEAD_LETTER_SUFFIX)))


def route_columns(attempt: Column, as_of: Column, topic: str | Column = S.ORDER_TOPIC,
                  max_attempts: int = S.MAX_ATTEMPTS) -> dict[str, Column]:
    """Where a failed attempt goes: next topic and attempt, delay, due time and
    whether it is a dead letter.  ``topic`` is the *main* topic name."""
    t = topic if isinstance(topic, Column) else F.lit(topic)
    delay = F.when(attempt < max_attempts, X.backoff_ms(attempt)).otherwise(F.lit(0)).cast("bigint")
    return {
        "nextTopic": next_topic(attempt, t, max_attempts),
        "nextAttempt": F.when(attempt < max_attempts, attempt + 1),
        "delayMs": delay,
        "dueAt": as_of + F.make_interval(secs=(delay / 1000.0).cast("decimal(18,6)")),
        "deadLetter": attempt >= max_attempts,
    }


def route_failures(df: DataFrame, ok_col: str, attempt_col: str, as_of: Column,
                   topic: str | Column = S.ORDER_TOPIC, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    """Failed rows of ``df`` with their next topic, attempt, delay and due
    time (retry topics share the main topic's prefix)."""
    return df.filter(~F.col(ok_col)).withColumns(
        route_columns(F.col(attempt_col), as_of, topic, max_attempts))


def with_due_retries(batch: DataFrame, retries: DataFrame, as_of: Column) -> DataFrame:
    """G1: one micro-batch's input = new records + retries that are due."""
    due = retries.filter(F.col("dueAt") <= as_of).select(*batch.columns)
    return batch.unionByName(due)


def attempts_of(records: DataFrame, fails, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    """Every attempt a record goes through, given ``fails(attempt) -> Column``
    (whether that attempt fails): attempts 1..first success, or all
    ``max_attempts``.  Row-local (no shuffle); at most ``max_attempts`` rows
    per record."""
    oks = F.transform(F.sequence(F.lit(1), F.lit(max_attempts)), lambda a: ~fails(a))
    first_ok = F.array_position(oks, True).cast("int")
    last = F.when(first_ok == 0, F.lit(max_attempts)).otherwise(first_ok)
    return (
        records.withColumn("_first_ok", first_ok)
        .withColumn("attempt", F.explode(F.sequence(F.lit(1), last)))
        .withColumn("ok", F.col("attempt") == F.col("_first_ok"))
        .drop("_first_ok")
    )
