"""String and emptiness expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_empty(value: Column) -> Column:
    """Null or zero length."""
    return value.isNull() | (F.length(value) == 0)


def market_base(market: Column) -> Column:
    """First part of "BASE-QUOTE"; null for null."""
    return F.get(F.split(market, "-"), F.lit(0))


def market_quote(market: Column) -> Column:
    """Second part of "BASE-QUOTE"; null when there is none."""
    return F.get(F.split(market, "-"), F.lit(1))
