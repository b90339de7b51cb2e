"""The trade stream: parse, admit, price, store."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeglass.operators import pricing
from tradeglass.operators.listing import admitted_as_of, intervals
from tradeglass.operators.upsert import last_per_key, unique_trades
from tradeglass.plans.jobs import Jobs
from tradeglass.session import cut_lineage, releasing, together
from tradeglass.sources.trades import decode_events, rejected_events, trades_from


class TradeStream:
    """Prices each micro-batch from the asset prices the batch before left, and merges it by trade id.  Trades count
    that happened while their market was listed, so a replay takes what the live stream took.

    A rerun of a batch reads the same prices and writes the same rows and the same price version, so it
    is harmless.  Batches are priced in the order they arrive; trades that come late are stored at once
    and priced again from their day by ``Jobs.reprice_from``.  With ``follow_late`` the stream does that itself: a
    trade before the newest price of one of its assets is priced in its place, with all that follows from it.
    """

    def __init__(self, jobs: Jobs, name: str = "main", *, follow_late: bool = False):
        self.jobs = jobs
        self.follow_late = follow_late
        self.store = jobs.store
        self.prices = f"asset_prices_{name}"
        self.quarantine = f"{self.store.root}/quarantine_{name}"

    def _previous_prices(self, batch_id: int) -> DataFrame:
        """State after the batch before; a stream that just starts takes the stored asset prices."""
        kept = self.store.read(self.prices, before=batch_id, schema_like="asset_prices")
        if batch_id > 0 and not kept.isEmpty():
            # Of a price and the same one after repricing, the latter counts; else the later trade.
            repriced = self.store.read("repriced_assets").withColumn("_again", F.lit(1))
            both = kept.withColumn("_again", F.lit(0)).unionByName(repriced)
            return last_per_key(both, ["asset_id"], [*pricing.ORDER, "_again"]).drop("_again")
        return self.store.read("assets").filter(F.col("price").isNotNull()).select(
            "asset_id",
            F.col("price").cast("double").alias("usd_price"),
            F.lit(None).cast("timestamp").alias("timestamp"),
            F.lit(None).cast("bigint").alias("trade_id"),
        )

    def process(self, events: DataFrame, batch_id: int) -> None:
        with self.jobs.writing_trades, releasing(self.store.spark):
            self._process(events, batch_id)

    def _process(self, events: DataFrame, batch_id: int) -> None:
        decoded = decode_events(events)
        config, store = self.jobs.config, self.store
        listed = intervals(store.read("market_history"), store.read("markets"))
        trades = admitted_as_of(trades_from(decoded), listed, config).drop("market")
        trades = unique_trades(cut_lineage(trades))
        before = self._previous_prices(batch_id)
        rejected = rejected_events(decoded).write.mode("overwrite")
        if self.follow_late:
            before = cut_lineage(before)
            ticks = pricing.seed_ticks(before, placed=True)
            priced = cut_lineage(pricing.price_trades(trades, config, ticks=ticks))
            after = last_per_key(pricing.asset_last_price(priced).unionByName(before), ["asset_id"], pricing.ORDER)
        else:
            priced = cut_lineage(pricing.price_trades(trades, config, seeds=before))
            after = pricing.asset_last_price(priced, before)
        together(
            lambda: self.jobs.merge(priced, newest=not self.follow_late),
            lambda: store.replace(self.prices, after, version=batch_id),
            lambda: rejected.parquet(f"{self.quarantine}/batch={batch_id}"),
        )
        if self.follow_late:
            late = cut_lineage(pricing.late_trades(priced, before))
            if not late.isEmpty():
                self.jobs.reprice_late(late)
            self.jobs.save_prices_in_force(priced)

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run on a stream of event texts; by default everything available now, then stop."""
        writer = events.writeStream.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(self.process).trigger(**(trigger or {"availableNow": True})).start()
