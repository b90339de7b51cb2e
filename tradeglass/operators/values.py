"""Value locked, fees, staking and treasury."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.dates import on
from tradeglass.functions.numeric import clamp_negative, floor_amount, rounded_count, usd_value
from tradeglass.operators.lastknown import latest_before
from tradeglass.schemas import BALANCE, FEES, PRICE, USD


def locked(balance: str, price: str) -> Column:
    """Value of a stored balance; null when either is missing."""
    return F.round(F.col(balance) * F.col(price), 2).cast(USD)


def asset_tvl(assets: DataFrame, balances: DataFrame) -> DataFrame:
    """Balance and value of each asset at its price; the value is null when either is missing."""
    raw = F.col("balance_raw")
    return assets.select("asset_id", "price").join(balances, "asset_id", "left").select(
        "asset_id",
        floor_amount(raw, 6).cast(BALANCE).alias("balance"),
        usd_value(raw, F.col("price")).cast(USD).alias("tvl"),
    )


def fee_values(assets: DataFrame) -> DataFrame:
    """Value of the stored fees of each asset at its price."""
    return assets.select(
        "asset_id",
        (F.col("fees") * F.col("price")).cast(USD).alias("fees_value"),
        (F.col("new_fees") * F.col("price")).cast(USD).alias("new_fees_value"),
    )


def fee_withdrawals_by_asset(withdrawals: DataFrame, assets: DataFrame) -> DataFrame:
    """Withdrawn total per asset of each symbol; several assets of one symbol get it each.

    Summed per symbol before the join, so a hot symbol is one row by then.
    """
    totals = withdrawals.groupBy("asset_symbol").agg(F.sum("amount").alias("amount"))
    by_symbol = assets.select("asset_id", F.col("symbol").alias("asset_symbol"))
    return totals.join(by_symbol, "asset_symbol").select(
        "asset_symbol", "asset_id", F.col("amount").cast(PRICE).alias("amount")
    )


def previous_fees(assets_daily: DataFrame, day: date) -> DataFrame:
    """Fee total of each asset's newest day before ``day``; a stored null counts as 0."""
    cut = on(day - timedelta(days=1))
    before = latest_before(assets_daily, ["asset_id"], "stat_date", cut, ["fees"])
    return before.select("asset_id", F.coalesce("fees", F.lit(0)).cast(FEES).alias("previous_fees"))


def asset_fees(
    assets: DataFrame, fee_balances: DataFrame, withdrawals: DataFrame, assets_daily: DataFrame, day: date
) -> DataFrame:
    """Cumulative fees (balance of the fee wallet plus everything withdrawn), their change since the previous
    day (not below 0, null for an asset without one) and both values at the current price."""
    withdrawn = fee_withdrawals_by_asset(withdrawals, assets).select("asset_id", "amount")
    joined = (
        assets.select("asset_id", "price")
        .join(fee_balances, "asset_id", "left")
        .join(withdrawn, "asset_id", "left")
        .join(previous_fees(assets_daily, day), "asset_id", "left")
    )
    held = floor_amount(F.col("balance_raw"), 6)
    fees = joined.withColumn("fees", (held + F.coalesce("amount", F.lit(0))).cast(FEES))
    fees = fees.withColumn("new_fees", clamp_negative(F.col("fees") - F.col("previous_fees")).cast(FEES))
    return fees.select(
        "asset_id",
        "fees",
        (F.col("fees") * F.col("price")).cast(USD).alias("fees_value"),
        "new_fees",
        (F.col("new_fees") * F.col("price")).cast(USD).alias("new_fees_value"),
    )


def fee_deltas(assets_daily: DataFrame) -> DataFrame:
    """Change of each asset's fees from day to day; a window over the days of one asset."""
    days = Window.partitionBy("asset_id").orderBy("stat_date")
    first = F.row_number().over(days) == 1
    change = F.col("fees") - F.coalesce(F.lag("fees").over(days), F.lit(0))
    return assets_daily.select(
        "stat_date",
        "asset_id",
        "fees",
        F.when(~first, clamp_negative(change)).cast(FEES).alias("new_fees"),
    )


def user_deltas(exchange_daily: DataFrame) -> DataFrame:
    """Change of the user count from day to day (it may be negative).  One row per day in all."""
    before = F.lag("users").over(Window.orderBy("stat_date"))
    return exchange_daily.select("stat_date", "users", (F.col("users") - before).alias("new_users"))


def user_metrics(total_users: DataFrame, previous: DataFrame) -> DataFrame:
    """Registered users and their change against the previous day; one row, none without a total."""
    known = total_users.filter(F.col("users").isNotNull())
    known = known.withColumn("_before", previous.select("users").scalar())
    return known.select("users", (F.col("users") - F.col("_before")).alias("new_users"))


def treasury_metrics(scalars: DataFrame, treasury: DataFrame, assets: DataFrame, config: ExchangeConfig) -> DataFrame:
    """One row with staked total, treasury balance and issuance, floored to cents and stored as whole
    numbers, and the USD value of the first two.  Without a price of the native asset only issuance is set.

    ``scalars``: (metric, value_raw) with metrics ``staked`` and ``issuance``; ``treasury``: balances of
    the treasury wallet.
    """
    native = F.col("asset_id") == config.native_asset
    price = assets.agg(F.max(F.when(native, F.col("price"))).alias("price"))

    def scalar(name: str):
        return F.max(F.when(F.col("metric") == name, F.col("value_raw"))).alias(name)

    held = treasury.agg(F.max(F.when(native, F.col("balance_raw"))).alias("treasury"))
    row = scalars.agg(scalar("staked"), scalar("issuance"))
    row = row.withColumns({"treasury": held.scalar(), "price": price.scalar()})
    priced = F.col("price").isNotNull()

    def whole(name: str):
        return rounded_count(floor_amount(F.col(name), 2))

    return row.select(
        F.when(priced, whole("staked")).alias("total_staked"),
        usd_value(F.col("staked"), F.col("price")).cast(USD).alias("staked_tvl"),
        F.when(priced, whole("treasury")).alias("treasury_balance"),
        usd_value(F.col("treasury"), F.col("price")).cast(USD).alias("treasury_tvl"),
        whole("issuance").alias("total_issuance"),
    )
