"""Which markets were listed when.

A listing is taken every few minutes and names all markets there are.  Its history holds an interval for each time a
market was listed without a break: from the moment of the first listing that names it (``valid_from``; null: ever
before) until the first that does not (``valid_to``; null: still listed).  The start counts, the end does not.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.dates import at
from tradeglass.operators.activity import PAIR

INTERVAL = [*PAIR, "valid_from", "valid_to"]


def listing_history(listings: DataFrame, moments: DataFrame) -> DataFrame:
    """The history of a set of listings at once, from (market, ``taken_at``) rows and all moments at which one was
    taken, those of empty listings included."""
    # One row per listing ever taken; this is the only place where all of them are put in one order.
    ordered = Window.orderBy("taken_at")
    numbered = moments.select("taken_at").distinct().select(
        "taken_at", F.row_number().over(ordered).alias("_at"), F.lead("taken_at").over(ordered).alias("_next")
    )
    rows = listings.select(*PAIR, "taken_at").distinct().join(numbered, "taken_at")
    # Listings in a row have one difference between their number and that of the market's rows.
    run = F.col("_at") - F.row_number().over(Window.partitionBy(*PAIR).orderBy("_at"))
    return (
        rows.withColumn("_run", run)
        .groupBy(*PAIR, "_run")
        .agg(F.min("taken_at").alias("valid_from"), F.max_by("_next", "_at").alias("valid_to"))
        .select(*INTERVAL)
    )


def listing_step(history: DataFrame, listed: DataFrame, as_of: datetime) -> DataFrame:
    """The history after one more listing.  What the first listing of all names counts as listed ever before; a rerun
    changes nothing."""
    first = history.isEmpty()
    still_open = history.filter(F.col("valid_to").isNull()).select(*PAIR, "valid_from", F.lit(True).alias("_open"))
    both = still_open.join(listed.select(*PAIR).distinct().withColumn("_listed", F.lit(True)), PAIR, "full_outer")
    start = F.lit(None).cast("timestamp") if first else at(as_of)
    stepped = both.select(
        *PAIR,
        F.when(F.col("_open"), F.col("valid_from")).otherwise(start).alias("valid_from"),
        F.when(F.col("_listed").isNull(), at(as_of)).alias("valid_to"),
    )
    # An interval that ends where it began held no moment.
    held = stepped.filter(~F.col("valid_from").eqNullSafe(F.col("valid_to")) | F.col("valid_to").isNull())
    return history.filter(F.col("valid_to").isNotNull()).select(*INTERVAL).unionByName(held)


def listed_at(history: DataFrame, moment: datetime) -> DataFrame:
    """The markets listed at a moment."""
    return history.filter(_within(at(moment))).select(*PAIR)


def _within(ts: Column) -> Column:
    since, until = F.col("valid_from"), F.col("valid_to")
    return (since.isNull() | (since <= ts)) & (until.isNull() | (ts < until))


def intervals(history: DataFrame, markets: DataFrame) -> DataFrame:
    """The history, and known markets that it does not name, as listed all the time."""
    unnamed = markets.select(*PAIR).distinct().join(history.select(*PAIR).distinct(), PAIR, "left_anti")
    never = F.lit(None).cast("timestamp")
    return history.select(*INTERVAL).unionByName(unnamed.select(*PAIR, never.alias("valid_from"), never.alias("valid_to")))


def admitted_as_of(trades: DataFrame, history: DataFrame, config: ExchangeConfig) -> DataFrame:
    """Trades of markets that were listed when they happened, with neither side blocked: a replay admits what a run
    admitted at the time.

    A semi join on the market; the interval is a condition on its few rows, which Spark broadcasts as long as
    they are below its size threshold.
    """
    blocked = config.blocked_assets
    open_trades = trades.filter(~F.col("base_asset_id").isin(*blocked) & ~F.col("quote_asset_id").isin(*blocked))
    spans = history.select(*[F.col(name).alias(f"_{name}") for name in PAIR], "valid_from", "valid_to")
    same = [F.col(name) == F.col(f"_{name}") for name in PAIR]
    return open_trades.join(spans, same[0] & same[1] & _within(F.col("timestamp")), "left_semi")
