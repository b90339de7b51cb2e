"""Order-book snapshots and the stored book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradeglass.functions.buckets import bucket_of
from tradeglass.functions.text import market_base, market_quote
from tradeglass.schemas import PRICE

LEVEL_KEY = ["base_asset_id", "quote_asset_id", "price", "side"]


def with_level_id(levels: DataFrame) -> DataFrame:
    """Add a hash of the level key.  As the first grouping and join key it makes sorting cheap: wide
    decimals are compared only where hashes are equal."""
    return levels.withColumn("level_id", F.xxhash64(*LEVEL_KEY))


def _complete() -> Column:
    """Whether a page holds an answer that can be read: null items are a failed call, and a level whose price
    or quantity is no number, or that has no side, spoils its page."""

    def readable(item: Column) -> Column:
        return item.p.try_cast(PRICE).isNotNull() & item.q.try_cast(PRICE).isNotNull() & item.s.isNotNull()

    return F.col("items").isNotNull() & F.coalesce(F.forall("items", readable), F.lit(False))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that cannot be used, for the quarantine folder."""
    return pages.filter(~_complete())


def snapshot_markets(pages: DataFrame) -> DataFrame:
    """Markets that have a snapshot at all.  A page with null items is a failed call and does not count;
    a page with an empty list does: it clears the book."""
    market = F.col("market")
    return (
        pages.filter(F.col("items").isNotNull())
        .select(market_base(market).alias("base_asset_id"), market_quote(market).alias("quote_asset_id"))
        .distinct()
    )


def snapshot_levels(pages: DataFrame) -> DataFrame:
    """Every level of every page, one row per (market, price, side); of copies the last one wins.

    Price is compared as a number, so "1.0" and "1.00" are one level.  The reduction is an aggregate,
    so copies of one hot level collapse before the shuffle.  Column ``level_id`` is kept for the join
    with the book, which then needs no second shuffle of the levels.
    """
    market, item = F.col("market"), F.col("item")
    rows = pages.select(market, "page", F.posexplode("items").alias("position", "item")).select(
        market_base(market).alias("base_asset_id"),
        market_quote(market).alias("quote_asset_id"),
        item.p.try_cast(PRICE).alias("price"),
        item.s.alias("side"),
        F.struct(
            "page", "position", item.q.try_cast(PRICE).alias("quantity"), item.stid.alias("stid")
        ).alias("level"),
    )
    last = with_level_id(rows).groupBy("level_id", *LEVEL_KEY).agg(F.max("level").alias("level"))
    return last.select("level_id", *LEVEL_KEY, "level.stid", "level.quantity")


def latest_snapshot(pages: DataFrame) -> DataFrame:
    """Pages of the newest complete snapshot of each market, of a folder holding several.  A snapshot with a
    page that failed or cannot be read is not complete; a market without a complete one is left out, so
    its stored book stays as it is."""
    complete = pages.groupBy("market", "snapshot_id").agg(F.bool_and(_complete()).alias("complete"))
    newest = complete.filter("complete").groupBy("market").agg(F.max("snapshot_id").alias("snapshot_id"))
    return pages.join(newest, ["market", "snapshot_id"], "left_semi")


def book_of(book: DataFrame, base: str, quote: str, buckets: int | None = None) -> DataFrame:
    """Stored levels of one market.  Of a book in ``buckets`` only the folder of its bucket is read."""
    if buckets is not None:
        book = book.filter(F.col("bucket") == bucket_of(buckets, F.lit(base), F.lit(quote)))
    return book.filter((F.col("base_asset_id") == base) & (F.col("quote_asset_id") == quote)).select(*LEVEL_KEY)
