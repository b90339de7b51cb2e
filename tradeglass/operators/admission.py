"""Which trades count, and referential checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.operators.activity import PAIR


def admitted_trades(trades: DataFrame, markets: DataFrame, config: ExchangeConfig) -> DataFrame:
    """Trades of a listed market with neither side blocked.

    The block list is a scan filter; the market check is a semi join, which Spark broadcasts as long as
    the market list is below its size threshold.
    """
    blocked = config.blocked_assets
    open_trades = trades.filter(
        ~F.col("base_asset_id").isin(*blocked) & ~F.col("quote_asset_id").isin(*blocked)
    )
    return open_trades.join(markets.select(*PAIR).distinct(), PAIR, "left_semi")


def unknown_assets(rows: DataFrame, assets: DataFrame, source: str, counted: str | None = None) -> DataFrame:
    """Asset ids used in ``rows`` that no asset row has, with the column they appear in and how often.

    Ids are counted before the join, so the join sees one row per id.  Where ``rows`` are sums, ``counted`` is
    the column with the number of rows summed.
    """
    number = F.count(F.lit(1)) if counted is None else F.sum(counted)
    pairs = rows.groupBy(*PAIR).agg(number.alias("n"))
    used = pairs.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("asset_id")) for name in PAIR]
            )
        ).alias("key"),
        "n",
    ).groupBy("key.column_name", "key.asset_id").agg(F.sum("n").alias("row_count"))
    missing = used.join(assets.select("asset_id"), "asset_id", "left_anti")
    return missing.select(F.lit(source).alias("table_name"), "column_name", "asset_id", "row_count")
