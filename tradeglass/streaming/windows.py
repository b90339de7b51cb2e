"""Continuous roll-ups of the trade stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeglass.operators.activity import PAIR
from tradeglass.plans.jobs import Jobs
from tradeglass.schemas import PRICE, VOLUME
from tradeglass.sources import chain


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trades"),
        F.sum("volume").cast(VOLUME).alias("volume"),
        F.sum("volume_quote").cast(PRICE).alias("volume_quote"),
        F.sum("quantity").cast(PRICE).alias("volume_base"),
    ]


def once(trades: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries of a trade id within ``lateness``."""
    return trades.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["trade_id"])


def tumbling(trades: DataFrame, length: str) -> DataFrame:
    """Figures per market and window of ``length`` ("1 day", "1 hour"); windows are [start, end)."""
    grouped = trades.groupBy(F.window("timestamp", length), *PAIR).agg(*_sums())
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *PAIR,
        "trades", "volume", "volume_quote", "volume_base",
    )


def sliding(trades: DataFrame, length: str = "24 hours", step: str = "5 minutes") -> DataFrame:
    """Figures per market over ``length``, moving by ``step``.

    Trades are summed per step first; only these sums are spread over the windows they belong to (288
    for a day in five-minute steps), not the trades.
    """
    panes = trades.groupBy(F.window("timestamp", step).alias("pane"), *PAIR).agg(*_sums())
    grouped = panes.groupBy(F.window(F.window_time("pane"), length, step), *PAIR).agg(
        *[F.sum(name).alias(name) for name in ("trades", "volume", "volume_quote", "volume_base")]
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *PAIR,
        "trades",
        F.col("volume").cast(VOLUME).alias("volume"),
        F.col("volume_quote").cast(PRICE).alias("volume_quote"),
        F.col("volume_base").cast(PRICE).alias("volume_base"),
    )


def append_to(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write closed windows to a parquet folder, each exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def store_transfers(pages: DataFrame, jobs: Jobs, checkpoint: str, **trigger) -> StreamingQuery:
    """Append transfers of landed pages once per id; the stream's checkpoint is the cursor."""

    def process(batch: DataFrame, batch_id: int) -> None:
        jobs.append_transfers(chain.transfers(batch))

    writer = pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def follow_book(pages: DataFrame, jobs: Jobs, checkpoint: str, clock, **trigger) -> StreamingQuery:
    """Reconcile the stored book with each batch of snapshot pages; ``clock()`` gives the time to stamp."""

    def process(batch: DataFrame, batch_id: int) -> None:
        jobs.update_book(batch, clock())

    writer = pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
