"""Hour snapshots and retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tradeglass.functions.dates import at, prune
from tradeglass.operators.lastknown import latest_row
from tradeglass.schemas import conform


def hour_of(as_of: datetime) -> datetime:
    return as_of.replace(minute=0, second=0, microsecond=0)


def assets_hourly(assets: DataFrame, as_of: datetime) -> DataFrame:
    """All assets as they are, stamped with the hour."""
    return conform(assets.withColumn("stat_time", at(hour_of(as_of))), "assets_hourly")


def exchange_hourly(exchange_daily: DataFrame, as_of: datetime) -> DataFrame:
    """The newest day row, stamped with the hour."""
    newest = latest_row(exchange_daily, "stat_date")
    return conform(newest.withColumn("stat_time", at(hour_of(as_of))), "exchange_hourly")


def retained_trades(trades: DataFrame, today: date, days: int = 60) -> DataFrame:
    """Trades after the midnight ``days`` ago; one exactly then is dropped."""
    cut = datetime(today.year, today.month, today.day) - timedelta(days=days)
    return prune(trades, cut.date()).filter(F.col("timestamp") > at(cut))


def retained_hourly(snapshots: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Snapshots after the moment ``days`` ago; one exactly then is dropped."""
    return snapshots.filter(F.col("stat_time") > at(as_of - timedelta(days=days)))


def replace_day(stored: DataFrame, rows: DataFrame, day: date) -> DataFrame:
    """``stored`` with the rows of ``day`` exchanged for ``rows``."""
    return stored.filter(F.col("stat_date") != F.lit(day)).unionByName(rows)


def freshness_stamp(spark, as_of: datetime) -> DataFrame:
    """One row with the time of the last order-book update."""
    return spark.range(1).select(at(as_of).alias("last_update"))
