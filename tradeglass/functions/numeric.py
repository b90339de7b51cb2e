"""Fixed-point expressions.

Chain amounts are integers in units of 10^-12.  The decimal widths below are chosen so that the
product is exact and flooring sees the true digits: a wider multiply would round first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNIT = "cast('0.000000000001' as decimal(12,12))"


def readable(raw: Column) -> Column:
    """Raw integer amount to whole units, exactly: decimal(37,12)."""
    return raw.cast("decimal(24,0)") * F.expr(_UNIT)


def floor_amount(raw: Column, digits: int) -> Column:
    """Raw integer amount to whole units, floored (towards minus infinity) at ``digits`` decimals."""
    return F.floor(readable(raw), F.lit(digits)).cast(f"decimal({24 - 12 + digits + 1},{digits})")


def usd_value(raw: Column, price: Column) -> Column:
    """Value of a raw integer amount at ``price``, two decimals; null when either side is missing.

    decimal(24,12) holds every 24-digit raw amount, and leaves the product 15 exact decimals.
    """
    amount = readable(raw).cast("decimal(24,12)")
    return F.round(amount * price.cast("decimal(20,10)"), 2)


def clamp_negative(value: Column) -> Column:
    """Negative to zero, null stays null."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def rounded_count(value: Column) -> Column:
    """Decimal to the nearest whole number, as stored in integer columns."""
    return F.round(value, 0).cast("bigint")


def number_or_null(value: Column) -> Column:
    """NaN to null."""
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)
