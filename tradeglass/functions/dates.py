"""Time expressions.  ``as_of`` stands for "now" and is always given by the caller, in UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

DAY = timedelta(days=1)


def at(moment: datetime) -> Column:
    """Timestamp literal in UTC (the session time zone the library sets)."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def on(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def stored_second(epoch_millis: Column) -> Column:
    """Epoch milliseconds to a timestamp rounded to the nearest second."""
    return F.date_trunc("second", F.timestamp_millis(epoch_millis + 500))


def in_current(ts: Column, as_of: datetime) -> Column:
    """Strictly after 24 hours ago, and not in the future of ``as_of``."""
    return (ts > at(as_of - DAY)) & (ts <= at(as_of))


def in_previous(ts: Column, as_of: datetime) -> Column:
    """The 24 hours before that, open at both ends."""
    return (ts < at(as_of - DAY)) & (ts > at(as_of - 2 * DAY))


def prune(trades: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Restrict the scan to the day partitions needed; a no-op for inputs without ``trade_date``."""
    if "trade_date" not in trades.columns:
        return trades
    if first is not None:
        trades = trades.filter(F.col("trade_date") >= on(first))
    if last is not None:
        trades = trades.filter(F.col("trade_date") <= on(last))
    return trades


def on_days(trades: DataFrame, days: list[date]) -> DataFrame:
    """Rows of some calendar days, given their day column."""
    return trades.filter(F.col("trade_date").isin(*[F.lit(day) for day in days]))


def on_day(trades: DataFrame, day: date) -> DataFrame:
    """Trades of one calendar day, comparing the raw column so that the filter reaches the scan."""
    start = datetime(day.year, day.month, day.day)
    ts = F.col("timestamp")
    return prune(trades, day, day).filter((ts >= at(start)) & (ts < at(start + DAY)))
