"""Row validation (B9, B10): every rule becomes an error-text column; the
errors of a row are an array, joined with ", " for the report text.
Rules are plain expressions evaluated per row on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schemas as S

# Java's String.trim() strips every char <= U+0020, so "blank" is that set.
_BLANK = r"^[\x00-\x20]*$"


def is_blank(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | col.rlike(_BLANK)


def _rule(failed: Column, field: str, message: str) -> Column:
    return F.when(failed, F.lit(f"{field}: {message}"))


def _collect(rules: list[Column]) -> Column:
    return F.filter(F.array(*rules), lambda e: e.isNotNull())


def event_errors(df: DataFrame) -> Column:
    """Errors of a P1 order event, in declared field order."""
    amount = F.col("totalAmount")
    rules = [
        _rule(is_blank("orderId"), "orderId", S.MSG_NOT_BLANK),
        _rule(is_blank("customerId"), "customerId", S.MSG_NOT_BLANK),
        _rule(is_blank("customerTier"), "customerTier", S.MSG_NOT_BLANK),
        _rule(is_blank("status"), "status", S.MSG_NOT_BLANK),
        _rule(amount.isNull(), "totalAmount", S.MSG_NOT_NULL),
        # a null amount fails only not-null; the minimum check passes on null
        _rule(amount < F.lit(S.MIN_AMOUNT).cast(S.AMOUNT), "totalAmount", S.MSG_MIN_AMOUNT),
        _rule(is_blank("currency"), "currency", S.MSG_NOT_BLANK),
        _rule(is_blank("region"), "region", S.MSG_NOT_BLANK),
    ]
    return _collect(rules)


def request_errors(df: DataFrame) -> Column:
    """Errors of a P2 order request, in declared field order."""
    m = S.REQUEST_MESSAGES
    amount = F.col("totalAmount")
    rules = [
        _rule(is_blank("customerId"), "customerId", m["customerId"]),
        _rule(is_blank("customerName"), "customerName", m["customerName"]),
        _rule(F.col("priority").isNull(), "priority", m["priority"]),
        _rule(is_blank("region"), "region", m["region"]),
        _rule(is_blank("category"), "category", m["category"]),
        _rule(F.coalesce(F.size("items"), F.lit(0)) == 0, "items", m["items"]),
        _rule(amount.isNull(), "totalAmount", S.MSG_NOT_NULL),
        _rule(amount < F.lit(S.MIN_AMOUNT).cast(S.AMOUNT), "totalAmount", m["totalAmount_min"]),
    ]
    return _collect(rules)


def _with_errors(df: DataFrame, errors: Column) -> DataFrame:
    return (
        df.withColumn("errors", errors)
        .withColumn("errorText", F.when(F.size("errors") > 0, F.array_join("errors", ", ")))
        .withColumn("isValid", F.size("errors") == 0)
    )


def validate_events(df: DataFrame) -> DataFrame:
    """``df`` + errors ARRAY<STRING>, errorText, isValid."""
    return _with_errors(df, event_errors(df))


def validate_requests(df: DataFrame) -> DataFrame:
    return _with_errors(df, request_errors(df))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the error columns, rejected rows with them)."""
    ok = validated.filter("isValid").drop("errors", "errorText", "isValid")
    rejected = validated.filter(~F.col("isValid"))
    return ok, rejected
