"""Trades as additive activity rows, and their sums per market and minute.

Roll-ups read activity: either trades, one row each, or *panes*, the same columns summed per market and
minute.  A trade at a whole minute has a pane of its own, all others of the minute share one; a pane's
time is that minute, or half a minute later.  So any bound at a whole minute (midnight, ``as_of`` of a
scheduled job) cuts panes exactly where it cuts trades, and figures from panes equal those from trades,
while their number does not grow with trading.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

PAIR = ["base_asset_id", "quote_asset_id"]
SUMS = ("trades", "volume", "volume_quote", "volume_base")


def pane_time(ts: Column) -> Column:
    minute = F.date_trunc("minute", ts)
    return F.when(ts == minute, ts).otherwise(minute + F.expr("INTERVAL 30 SECONDS"))


def closing() -> list[Column]:
    """The trade with the greatest id of a group, and its price."""
    return [F.max("close_id").alias("close_id"), F.max_by("close_price", "close_id").alias("close_price")]


def activity(rows: DataFrame) -> DataFrame:
    """Trades as activity rows; panes as they are."""
    if "trades" in rows.columns:
        return rows
    return rows.withColumns(
        {
            "trades": F.lit(1).cast("bigint"),
            "volume_base": F.col("quantity"),
            "price_low": F.col("price"),
            "price_high": F.col("price"),
            "close_id": F.col("trade_id"),
            "close_price": F.col("price"),
        }
    )


def panes(trades: DataFrame) -> DataFrame:
    """Activity per market and minute (partial aggregation; a hot market is one row per minute and task)."""
    return (
        activity(trades)
        .groupBy(pane_time(F.col("timestamp")).alias("timestamp"), *PAIR)
        .agg(
            *[F.sum(name).alias(name) for name in SUMS],
            F.min("price_low").alias("price_low"),
            F.max("price_high").alias("price_high"),
            *closing(),
        )
        .withColumn("trade_date", F.to_date("timestamp"))
    )


def exact_for(as_of: datetime) -> bool:
    """Whether panes can be cut at ``as_of``."""
    return as_of.second == 0 and as_of.microsecond == 0
