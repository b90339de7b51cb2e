"""The last 24 hours against the 24 hours before.

All three dashboards come from one aggregate per market: it reads 48 hours of activity (trades or panes)
once, and per-asset and exchange figures are sums over its few rows, so nothing is read or doubled again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tradeglass.functions.dates import DAY, at, in_current, in_previous, prune
from tradeglass.operators.activity import PAIR, SUMS, activity, closing
from tradeglass.operators.lastknown import latest_before, latest_row, one
from tradeglass.schemas import ASSET_MEASURES, EXCHANGE_MEASURES, conform, schema_of


def market_windows(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Per market: counts, sums and price range of the current window, counts and sums of the previous."""
    ts = F.col("timestamp")
    recent = prune(rows, (as_of - 2 * DAY).date(), as_of.date()).filter(
        (ts > at(as_of - 2 * DAY)) & (ts <= at(as_of))
    )
    current, previous = in_current(ts, as_of), in_previous(ts, as_of)

    def sums(window: Column, prefix: str) -> list[Column]:
        return [F.sum(F.when(window, F.col(name))).alias(f"{prefix}{name}") for name in SUMS]

    return activity(recent).groupBy(*PAIR).agg(
        *sums(current, ""),
        *sums(previous, "previous_"),
        F.min(F.when(current, F.col("price_low"))).alias("price_low"),
        F.max(F.when(current, F.col("price_high"))).alias("price_high"),
    )


def market_closes(rows: DataFrame) -> DataFrame:
    """Trade with the greatest id per market and day.  Kept as a table, it stands in for all older activity
    when looking up the price 24 hours ago."""
    return activity(rows).groupBy(F.to_date("timestamp").alias("trade_date"), *PAIR).agg(*closing())


def price_before(rows: DataFrame, cut: datetime, closes: DataFrame | None = None) -> DataFrame:
    """Per market the price of the greatest trade id not after ``cut`` (by id, not by time).

    With ``closes`` only the day of the cut is read from the activity; days before it come from there.
    """
    day = cut.date()
    recent = prune(rows, None if closes is None else day, day).filter(F.col("timestamp") <= at(cut))
    if closes is not None:
        recent = recent.filter(F.col("timestamp") >= at(datetime(day.year, day.month, day.day)))
    last = activity(recent).select(*PAIR, "close_id", "close_price")
    if closes is not None:
        last = last.unionByName(closes.filter(F.col("trade_date") < F.lit(day)).select(*last.columns))
    return last.groupBy(*PAIR).agg(F.max_by("close_price", "close_id").alias("price_24h"))


def markets_24h(
    trades: DataFrame,
    markets: DataFrame,
    assets: DataFrame,
    as_of: datetime,
    *,
    closes: DataFrame | None = None,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Every market whose two assets exist; zeros where idle, no price range where idle.

    ``trades`` may be panes.  ``windows`` are ``market_windows`` of them, if at hand.
    """
    windows = market_windows(trades, as_of) if windows is None else windows
    known = assets.select("asset_id")
    listed = markets.select(*PAIR)
    for side in PAIR:
        listed = listed.join(known.withColumnRenamed("asset_id", side), side, "left_semi")
    joined = listed.join(windows, PAIR, "left").join(price_before(trades, as_of - DAY, closes), PAIR, "left")
    zeros = {f"{prefix}{name}": 0 for prefix in ("", "previous_") for name in SUMS}
    filled = joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in [*zeros, "price_24h"]}
    )
    return conform(filled, "markets_24h")


def asset_windows(windows: DataFrame) -> DataFrame:
    """Market windows summed per asset, an asset taking part as base and as quote."""
    names = ["trades", "volume", "previous_trades", "previous_volume"]
    legs = windows.select(F.explode(F.array(*PAIR)).alias("asset_id"), *names)
    return legs.groupBy("asset_id").agg(*[F.sum(name).alias(name) for name in names])


def assets_24h(
    trades: DataFrame,
    assets: DataFrame,
    assets_hourly: DataFrame,
    as_of: datetime,
    *,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Every asset: its figures now, trades of both legs, and its hourly snapshot of a day ago."""
    windows = market_windows(trades, as_of) if windows is None else windows
    before = latest_before(assets_hourly, ["asset_id"], "stat_time", at(as_of - DAY), ASSET_MEASURES)
    before = before.select("asset_id", *[F.col(name).alias(f"previous_{name}") for name in ASSET_MEASURES])
    joined = (
        assets.select("asset_id", *ASSET_MEASURES)
        .join(asset_windows(windows), "asset_id", "left")
        .join(before, "asset_id", "left")
    )
    zero = [f.name for f in schema_of("assets_24h") if f.name not in ("asset_id", "balance")]
    return conform(joined.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in zero}), "assets_24h")


def exchange_24h(
    trades: DataFrame,
    exchange_daily: DataFrame,
    exchange_hourly: DataFrame,
    as_of: datetime,
    *,
    windows: DataFrame | None = None,
) -> DataFrame:
    """One row: the newest day, the snapshots one and two days ago, trades of both windows.  No row while
    there is no day yet.  The parts are scalar subqueries."""
    windows = market_windows(trades, as_of) if windows is None else windows
    totals = windows.agg(
        *[
            F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in ("trades", "volume", "previous_trades", "previous_volume")
        ]
    )

    def snapshot(cut: datetime) -> Column:
        older = exchange_hourly.filter(F.col("stat_time") <= at(cut))
        return older.agg(F.max_by(F.struct(*EXCHANGE_MEASURES), "stat_time")).scalar()

    row = latest_row(exchange_daily, "stat_date").withColumns(
        {"_sums": one(totals), "_day": snapshot(as_of - DAY), "_two_days": snapshot(as_of - 2 * DAY)}
    )

    def measure(name: str) -> dict[str, Column]:
        now, before = F.coalesce(F.col(name), F.lit(0)), F.coalesce(F.col(f"_day.{name}"), F.lit(0))
        if name in ("trades", "volume"):
            now, before = F.col(f"_sums.{name}"), F.col(f"_sums.previous_{name}")
        if name == "new_users":
            users = [F.coalesce(F.col(c), F.lit(0)) for c in ("users", "_day.users", "_two_days.users")]
            now, before = users[0] - users[1], users[1] - users[2]
        return {name: now, f"previous_{name}": before}

    columns: dict[str, Column] = {}
    for name in EXCHANGE_MEASURES:
        columns |= measure(name)
    return conform(row.select(*[column.alias(name) for name, column in columns.items()]), "exchange_24h")
