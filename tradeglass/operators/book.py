"""Order-book reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeglass.schemas import conform
from tradeglass.sources.orderbook import LEVEL_KEY, with_level_id

_MARKET = ["base_asset_id", "quote_asset_id"]


def book_changes(book: DataFrame, levels: DataFrame, markets: DataFrame) -> DataFrame:
    """Each level of the markets that have a snapshot, labelled insert, update, delete or same.

    One full outer join on the level key.  The key contains the price, so the levels of a busy market
    spread over all tasks.  An existing level keeps its stid.
    """
    covered = with_level_id(book.join(markets.select(*_MARKET), _MARKET, "left_semi"))
    old = covered.select("level_id", *LEVEL_KEY, F.struct("stid", "quantity").alias("_old"))
    new = levels.select("level_id", *LEVEL_KEY, F.struct("stid", "quantity").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old.quantity").eqNullSafe(F.col("_new.quantity")), "same")
        .otherwise("update")
    )
    return old.join(new, ["level_id", *LEVEL_KEY], "full_outer").select(
        *LEVEL_KEY,
        F.when(F.col("_old").isNull(), F.col("_new.stid")).otherwise(F.col("_old.stid")).alias("stid"),
        F.col("_old.quantity").alias("old_quantity"),
        F.col("_new.quantity").alias("quantity"),
        change.alias("change"),
    )


def apply_snapshot(book: DataFrame, levels: DataFrame, markets: DataFrame) -> DataFrame:
    """The book after the snapshot; markets without one are left as they are."""
    after = book_changes(book, levels, markets).filter(F.col("change") != "delete")
    untouched = book.join(markets.select(*_MARKET), _MARKET, "left_anti")
    return conform(after, "orderbook").unionByName(conform(untouched, "orderbook"))
