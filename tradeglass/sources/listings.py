"""Asset and market listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.text import market_base, market_quote
from tradeglass.schemas import PRICE


def asset_listing(pages: DataFrame, config: ExchangeConfig) -> DataFrame:
    """All pages of the listing: one row per asset, blocked ids dropped, stable assets at their pinned price.

    An asset listed twice keeps its last entry (by page where pages are numbered, then by position).
    """
    numbered = ["page"] if "page" in pages.columns else []
    entries = pages.select(*numbered, F.posexplode("items").alias("position", "item"))
    item = F.col("item")
    listed = entries.filter(~item["asset_id"].isin(*config.blocked_assets))
    last = F.max(F.struct(*numbered, "position", item["name"].alias("name"), item["symbol"].alias("symbol")))
    single = listed.groupBy(item["asset_id"].alias("asset_id")).agg(last.alias("d"))
    pinned = F.when(F.col("asset_id").isin(*config.stable_assets), F.lit(config.stable_price).cast(PRICE))
    return single.select("asset_id", "d.symbol", "d.name", pinned.alias("price"))


def split_markets(markets: DataFrame) -> DataFrame:
    """Add base and quote asset of column ``market``."""
    return markets.withColumns(
        {"base_asset_id": market_base(F.col("market")), "quote_asset_id": market_quote(F.col("market"))}
    )


def market_listing(pages: DataFrame, assets: DataFrame, config: ExchangeConfig) -> DataFrame:
    """Markets whose two assets are listed and not blocked, one row per market string."""
    listed = split_markets(pages.select(F.explode("items.market").alias("market")))
    blocked = config.blocked_assets
    listed = listed.filter(~F.col("base_asset_id").isin(*blocked) & ~F.col("quote_asset_id").isin(*blocked))
    known = assets.select("asset_id")
    # Only the pairs that are kept are made distinct, so only those are shuffled.
    return listed.join(
        known.withColumnRenamed("asset_id", "base_asset_id"), "base_asset_id", "left_semi"
    ).join(known.withColumnRenamed("asset_id", "quote_asset_id"), "quote_asset_id", "left_semi").select(
        "market", "base_asset_id", "quote_asset_id"
    ).distinct()
