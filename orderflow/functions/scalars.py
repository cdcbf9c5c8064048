"""Column-level helpers.  All of them are built-in Spark expressions that run
on the executors (no Python UDFs); the array folds use Spark's higher-order
functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow import schemas as S

_U32 = 4294967296  # 2^32
_I31 = 2147483648  # 2^31


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- H1
def java_string_hash_u32(c) -> Column:
    """``String.hashCode()`` of a column as an unsigned 32-bit BIGINT.

    The 31-polynomial runs over UTF-16 code units: a character outside the BMP
    contributes its two surrogates.  BIGINT with a 2^32 modulus keeps every
    step exact under ANSI mode (INT arithmetic would overflow).
    """
    k = _col(c)
    code_points = F.transform(F.split(k, ""), F.ascii)  # the text is walked once

    def step(acc, cp):
        high = F.lit(0xD800) + F.shiftright(cp - 0x10000, 10)
        low = F.lit(0xDC00) + (cp - 0x10000).bitwiseAND(F.lit(0x3FF))
        pair = (((acc * 31 + high) % _U32) * 31 + low) % _U32
        return F.when(cp > 0xFFFF, pair).otherwise((acc * 31 + cp) % _U32)

    folded = F.aggregate(code_points, F.lit(0).cast("bigint"), step)
    # how the empty string splits doesn't matter
    return F.when(F.char_length(k) == 0, F.lit(0).cast("bigint")).otherwise(folded)


def java_string_hash(c) -> Column:
    """Signed 32-bit ``String.hashCode()`` (as BIGINT)."""
    return (java_string_hash_u32(c) + _I31) % _U32 - _I31


def java_abs_hash(c) -> Column:
    """``|hashCode|`` computed in BIGINT, so the MIN_VALUE case is 2^31 rather
    than staying negative: every lane derived from it is valid."""
    return F.abs(java_string_hash(c))


# ----------------------------------------------------------------------- B1-B3
def partition_key(tier, customer_id) -> Column:
    """``tier + ":" + customerId``; a null prints as ``null`` like Java concat."""
    return F.concat(
        F.coalesce(_col(tier), F.lit("null")), F.lit(":"), F.coalesce(_col(customer_id), F.lit("null"))
    )


def tier_lane(key, lanes: int = S.TIER_LANES) -> Column:
    """Lane of a tier-routed key: PREMIUM (and null keys) on lane 0, everything
    else spread over lanes 1..n-1 by the customer id's Java hash."""
    k = _col(key)
    if lanes <= 1:
        return F.lit(0)
    cust = F.when(k.contains(":"), F.try_element_at(F.split(k, ":"), F.lit(2))).otherwise(k)
    spread = (java_abs_hash(F.coalesce(cust, F.lit(""))) % (lanes - 1) + 1).cast("int")
    return (
        F.when(k.isNull(), F.lit(0))
        .when(k.startswith(S.PREMIUM + ":"), F.lit(0))
        .otherwise(spread)
    ).cast("int")


def priority_key_parts(key) -> tuple[Column, Column]:
    """(priority, customerId) of a ``priority:customerId`` key (split at the
    first ``:``; a null key reads as ""; no ``:`` -> the whole key is both)."""
    k = F.coalesce(_col(key), F.lit(""))
    parts = F.split(k, ":", 2)
    cust = F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2))).otherwise(k)
    return parts.getItem(0), cust


def priority_lane_of(priority: Column, abs_hash: Column, lanes: int = S.PRIORITY_LANES) -> Column:
    """Priority lane from the parts and the customer's |hash| (so one hash can
    feed several lane layouts)."""
    h = abs_hash
    if lanes < 8:
        return (h % lanes).cast("int")
    return (
        F.when(priority == "FLASH_SALE", 6 + h % 2)
        .when(priority == "EXPRESS", 4 + h % 2)
        .otherwise(h % 4)
    ).cast("int")


def priority_lane(key, lanes: int = S.PRIORITY_LANES) -> Column:
    """Lane of a priority-routed key ``priority:customerId``.

    With 8+ lanes FLASH_SALE owns 6-7, EXPRESS 4-5 and everything else 0-3;
    with fewer lanes the customer hash alone picks one.
    """
    priority, cust = priority_key_parts(key)
    return priority_lane_of(priority, java_abs_hash(cust), lanes)


def routing_label(tier) -> Column:
    return F.when(_col(tier) == S.PREMIUM, F.lit(S.PREMIUM_ROUTE_LABEL)).otherwise(F.lit(S.STANDARD_ROUTE_LABEL))


# --------------------------------------------------------------------------- H3
def normalize_enum(c, allowed: list[str]) -> Column:
    """Upper-cased value, or null when it is not one of ``allowed``."""
    up = F.upper(_col(c))
    return F.when(up.isin(*allowed), up)


def check_enum(value: str, allowed: list[str], what: str = "value") -> str:
    """Driver-side parameter check (a request argument, not data)."""
    up = (value or "").upper()
    if up not in allowed:
        raise ValueError(f"Invalid {what}: {value}")
    return up


# --------------------------------------------------------------------------- H4
def padded(c, width: int) -> Column:
    """A number as text with zeros in front up to ``width``; a longer one stays whole."""
    text = _col(c).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def order_id(id_hex: int = 8) -> Column:
    """``ORD-`` + upper-case hex taken from a random UUID.

    ``id_hex=8`` is the reference's 32-bit id; pass up to 32 for a wider one.
    ``uuid()`` is re-evaluated on recomputation, so write the result once
    before fanning it out.
    """
    hexchars = F.regexp_replace(F.expr("uuid()"), "-", "")
    return F.concat(F.lit(S.ORDER_ID_PREFIX), F.upper(F.substring(hexchars, 1, id_hex)))


# ------------------------------------------------------------------- H6 / H13
def money(c) -> Column:
    """Round HALF_UP to 2 places in the money type (decimal round is HALF_UP)."""
    return F.round(_col(c).cast("decimal(38,6)"), 2).cast(S.AMOUNT)


def pct(part, total) -> Column:
    """Rounded percent as the dashboard computes it: ``Math.round(c/t*100)``."""
    x = _col(part).cast("double") / _col(total).cast("double") * 100.0
    return F.floor(x + 0.5).cast("bigint")


# --------------------------------------------------------------------- H7 / H8
def hour_label(ts) -> Column:
    """UTC hour bucket as text, e.g. ``2024-01-15T10:00:00Z``."""
    return F.date_format(F.date_trunc("hour", _col(ts)), "yyyy-MM-dd'T'HH:00:00'Z'")


def iso_text(ts) -> Column:
    """ISO-8601 instant text as ``Instant.toString`` prints it: seconds, and a
    3- or 6-digit fraction only when it is non-zero."""
    t = _col(ts)
    micros = F.unix_micros(t.cast("timestamp")) % 1000000
    return (
        F.when(t.isNull(), F.lit(None))
        .when(micros == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def parse_iso(c) -> Column:
    return F.to_timestamp(_col(c))


# ------------------------------------------------------------------------- H11
def item_count(items) -> Column:
    """Number of items, 0 for a null list (``size(NULL)`` is NULL under ANSI)."""
    return F.coalesce(F.size(_col(items)), F.lit(0))


def items_total(items) -> Column:
    """Order total from its items: sum of unitPrice * quantity, 2 places."""
    zero = F.lit(0).cast("decimal(38,2)")
    summed = F.aggregate(
        _col(items),
        zero,
        lambda acc, i: (acc + i["unitPrice"] * i["quantity"]).cast("decimal(38,2)"),
    )
    return money(summed)


# --------------------------------------------------------------------------- I3
def backoff_ms(attempt, base: int = S.BACKOFF_BASE_MS, multiplier: float = S.BACKOFF_MULTIPLIER,
               cap: int = S.BACKOFF_MAX_MS) -> Column:
    """Delay before the next attempt after failing ``attempt`` (1-based)."""
    raw = F.lit(base) * F.pow(F.lit(multiplier), _col(attempt) - 1)
    return F.least(raw, F.lit(float(cap))).cast("bigint")
