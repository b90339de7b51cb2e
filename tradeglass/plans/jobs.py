"""The scheduled jobs.  Each may be run again for the same ``as_of`` with the same result.

Inputs are refreshed before the figures that use them.  A failing step is recorded and does not stop
the others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from threading import RLock

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.dates import at
from tradeglass.operators import admission, book, daily, hourly, listing, pricing, rolling, upsert, values
from tradeglass.operators.activity import PAIR, exact_for, pane_time, panes
from tradeglass.operators.lastknown import one
from tradeglass.plans.store import Merged, Store
from tradeglass.schemas import EXCHANGE_MEASURES, PRICE, conform, schema_of
from tradeglass.session import cut_lineage, releasing, together
from tradeglass.sources import chain, listings, orderbook


@dataclass
class Landed:
    """Landed inputs of a refresh; a missing one skips its step."""

    asset_pages: DataFrame | None = None
    market_pages: DataFrame | None = None
    balances: DataFrame | None = None
    metrics: DataFrame | None = None
    roles: DataFrame | None = None
    scalars: DataFrame | None = None
    transfer_pages: DataFrame | None = None


@dataclass
class Report:
    """Outcome of each step: "ok", "skipped" or the error."""

    spark: SparkSession
    steps: dict[str, str] = field(default_factory=dict)

    def run(self, name: str, step: Callable[[], object]) -> None:
        try:
            with releasing(self.spark):
                self.steps[name] = "skipped" if step() is False else "ok"
        except Exception as error:  # a failed step must not stop the job
            self.steps[name] = f"{type(error).__name__}: {error}"

    @property
    def ok(self) -> bool:
        return all(outcome in ("ok", "skipped") for outcome in self.steps.values())


class Jobs:
    def __init__(self, store: Store, config: ExchangeConfig):
        self.store = store
        self.config = config
        self.spark = store.spark
        self._locks: defaultdict[str, RLock] = defaultdict(RLock)
        # Held by whatever writes trades and what is kept along with them: a batch of a stream, repricing,
        # backfill, compaction and retention.
        self.writing_trades = RLock()
        for table in ("trades", "markets_daily", "assets_daily", "fee_withdrawals"):
            store.recover(table)

    def _update(self, table: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """Read a small table, change it, write it; one at a time per table, as the stream and the jobs of
        one driver share some."""
        with self._locks[table]:
            self.store.replace(table, change(self.store.read(table)))

    # --- inputs -----------------------------------------------------------------------------------

    def _save_assets(self, rows: DataFrame) -> None:
        """Merge a partial set of asset columns into the asset table."""

        def merged(stored: DataFrame) -> DataFrame:
            names = [c for c in ("symbol", "name") if c not in rows.columns]
            given = rows.join(stored.select("asset_id", *names), "asset_id", "left")
            absent = {f.name: F.lit(None).cast(f.dataType) for f in stored.schema if f.name not in given.columns}
            source = given.withColumns({**absent, "is_active": F.lit(True)})
            return upsert.upsert_assets(stored, conform(source, "assets"))

        self._update("assets", merged)

    def _save_markets(self, rows: DataFrame) -> None:
        source = conform(rows.withColumn("is_active", F.lit(True)), "markets")
        self._update("markets", lambda stored: upsert.upsert_markets(stored, source))

    def save_listed_assets(self, pages: DataFrame) -> None:
        listed = listings.asset_listing(pages, self.config)
        self._save_assets(pricing.keep_prices(listed, self.store.read("assets")))

    def save_listed_markets(self, pages: DataFrame, as_of: datetime) -> None:
        """Merge the listed markets, note since when they are listed, and since when others no longer are."""
        listed = cut_lineage(listings.market_listing(pages, self.store.read("assets"), self.config))
        self._save_markets(listed.withColumn("price", F.lit(None)))
        if listed.isEmpty():
            return  # an empty answer is no listing
        self._update("market_history", lambda history: listing.listing_step(history, listed, as_of))
        gone = listed.select(*PAIR, F.lit(True).alias("_listed"))
        self._update(
            "markets",
            lambda stored: conform(
                stored.join(gone, PAIR, "left").withColumn("is_active", F.coalesce("_listed", F.lit(False))), "markets"
            ),
        )

    def save_trade_prices(self, priced: DataFrame) -> None:
        """Latest market prices, and latest USD asset prices, of a set of priced trades.  The value locked
        follows at once, from the stored balance; the next refresh takes it from the exact one."""
        together(
            lambda: self._save_markets(pricing.market_last_price(priced)),
            lambda: self._save_prices(pricing.asset_last_price(priced)),
        )

    def save_prices_in_force(self, priced: DataFrame) -> None:
        """The last prices of the markets and base assets of some stored trades, whether those made them or not."""
        closes, last = self.store.read("asset_closes").drop("trade_date"), self.store.read("market_closes")
        bases = priced.select(F.col("base_asset_id").alias("asset_id")).distinct()
        mine = last.join(priced.select(*PAIR).distinct(), PAIR, "left_semi")
        newest = mine.groupBy(*PAIR).agg(F.max_by("close_price", "close_id").cast(PRICE).alias("price"))
        made = upsert.last_per_key(closes.join(bases, "asset_id", "left_semi"), ["asset_id"], pricing.ORDER)
        together(lambda: self._save_markets(newest), lambda: self._save_prices(made))

    def _save_prices(self, prices: DataFrame) -> None:
        listed = self.store.read("assets").select("asset_id", "balance")
        newest = prices.select("asset_id", F.col("usd_price").cast(PRICE).alias("price"))
        self._save_assets(newest.join(listed, "asset_id").select("asset_id", "price", values.locked("balance", "price").alias("tvl")))

    def save_values(self, balances: DataFrame) -> None:
        assets = self.store.read("assets")
        pool = chain.wallet_balances(balances, assets, self.config.pool_wallet)
        # The value of the fees follows the price here, even if the step that counts them fails.
        self._save_assets(values.asset_tvl(assets, pool).join(values.fee_values(assets), "asset_id"))

    def save_fees(self, balances: DataFrame, today: date) -> None:
        assets = self.store.read("assets")
        held = chain.wallet_balances(balances, assets, self.config.fee_wallet)
        fees = values.asset_fees(
            assets, held, self.store.read("fee_withdrawals"), self.store.read("assets_daily"), today
        )
        self._save_assets(fees)

    def save_transfers(self, pages: DataFrame) -> None:
        """Store the transfers after the cursor, then move the cursor behind them."""
        with self._locks["fee_withdrawals"]:
            self._save_transfers(pages)

    def _save_transfers(self, pages: DataFrame) -> None:
        block, event = chain.cursor_value(self.store.read("metadata"))
        page = cut_lineage(
            chain.transfers_after(chain.transfers(pages), block, event, self.config.transfer_page_rows)
        )
        self.append_transfers(page)
        self._update("metadata", lambda stored: upsert.upsert_metadata(stored, chain.cursor_rows(page)))

    def append_transfers(self, rows: DataFrame) -> None:
        """Append transfers with an unseen id.  One writer at a time, as each must see what the other wrote."""
        with self._locks["fee_withdrawals"]:
            required, order = ["transfer_id", "asset_symbol", "amount"], ["block_num", "event_idx"]
            self.store.append_new("fee_withdrawals", rows, required, order)

    def save_measures(self, landed: Landed, today: date) -> None:
        """Users, holders, stakers, staked total, treasury and issuance into today's row."""
        store = self.store
        supplied: dict[str, object] = {}
        if landed.metrics is not None:
            metrics = chain.latest_metrics(landed.metrics)
            total = metrics.filter(F.col("metric") == "users").select(F.col("value").alias("users"))
            users = one(values.user_metrics(total, daily.previous_users(store.read("exchange_daily"), today)))
            holders = metrics.filter(F.col("metric") == "holders").select("value").scalar()
            supplied |= {"users": users["users"], "new_users": users["new_users"], "total_holders": holders}
        if landed.roles is not None:
            answered = chain.role_count(landed.roles).filter(F.col("stakers").isNotNull())
            supplied["total_stakers"] = answered.agg(F.max_by("stakers", "observed_at")).scalar()
        if landed.scalars is not None and landed.balances is not None:
            assets = store.read("assets")
            treasury = chain.wallet_balances(landed.balances, assets, self.config.treasury_wallet)
            row = values.treasury_metrics(chain.latest_scalars(landed.scalars), treasury, assets, self.config)
            figures = one(row)
            supplied |= {name: figures[name] for name in row.columns}
        kinds = {f.name: f.dataType for f in schema_of("exchange_daily")}
        one_row = self.spark.range(1).select(
            *[supplied[n].cast(kinds[n]).alias(n) for n in EXCHANGE_MEASURES if n in supplied]
        )
        assets = store.read("assets")
        self._update("exchange_daily", lambda days: daily.exchange_daily_measures(days, assets, one_row, today))

    # --- figures ----------------------------------------------------------------------------------

    def _roll_forward(self, today: date) -> None:
        self._update("exchange_daily", lambda days: daily.new_day_rollforward(days, today))

    def _close_alltime(self) -> None:
        self.store.replace("exchange_alltime", daily.exchange_alltime(self.store.read("exchange_daily")))

    def _day_tables(self, day: date) -> None:
        """From panes, and the pairs ever traded from the closes: no trade is read."""
        store = self.store
        panes, assets = store.read("market_panes"), store.read("assets")
        traded = daily.traded_pairs(store.read("market_closes"))
        per_asset = daily.assets_daily(panes, assets, day)
        per_market = daily.markets_daily(panes, store.read("markets"), day, traded=traded)
        together(
            lambda: store.replace_partition("assets_daily", per_asset, day),
            lambda: store.replace_partition("markets_daily", per_market, day),
        )

    def settle_days(self, today: date) -> list[date]:
        """Take the tables of finished days anew whose trades changed since, as the ledger has it; returns the days.

        Days that a lost driver left between its trades and what is kept along with them are summed again
        first.  Entries go once their days are done; today's stay until today is over, and days that
        retention has cut into are left as they are.
        """
        with self.writing_trades, releasing(self.spark):
            touched = self.store.touched_days()
            lost = sorted({day for one in touched if not one.kept for day in one.days})
            if lost:
                self._summarise_days(lost)
                self._add_asset_closes(self.store.read("trades").filter(F.col("trade_date").isin(lost)), lost)
            oldest = today - timedelta(days=self.config.trade_retention_days)
            days = sorted({day for one in touched for day in one.days if oldest < day < today})
            if days:
                self._redo_days(days)
            self.store.mark_days({day for one in touched for day in one.days if day >= today}, kept=True)
            self.store.forget(touched)
            return days

    def _redo_days(self, days: list[date]) -> None:
        """The day tables of past days, from panes: no trade is read."""
        store = self.store
        panes, assets = store.read("market_panes"), store.read("assets")
        traded = daily.traded_pairs(store.read("market_closes"))
        per_market = daily.markets_days(panes, store.read("markets"), days, traded=traded)
        per_asset = daily.assets_days(panes, assets, store.read("assets_daily"), days)
        together(
            lambda: store.exchange_all("assets_daily", per_asset, days),
            lambda: store.exchange_all("markets_daily", per_market, days),
            lambda: self._update("exchange_daily", lambda rows: daily.exchange_days_close(rows, panes, days)),
        )
        self._close_alltime()

    # --- kept along with the trades ---------------------------------------------------------------

    def _summarise_days(self, days: list[date] | None) -> None:
        """Panes and market closes of whole days (None: all), from their trades."""
        store = self.store

        def of_days(table: str) -> DataFrame:
            rows = store.read(table)
            return rows if days is None else rows.filter(F.col("trade_date").isin(days))

        summed = conform(panes(of_days("trades")), "market_panes", "trade_date")
        store.overwrite_partitions("market_panes", summed)
        traded = store.partitions("trades")
        store.drop_partitions("market_panes", lambda day: day not in traded)
        closes = rolling.market_closes(of_days("market_panes"))
        store.overwrite_partitions("market_closes", conform(closes, "market_closes", "trade_date"))
        store.drop_partitions("market_closes", lambda day: day not in traded)

    def _add_panes(self, merged: Merged) -> None:
        """Take the panes the batch falls into anew: trades are read only within its time range."""
        ts, keys = F.col("timestamp"), ["pane", *PAIR]
        touched = merged.rows.select(pane_time(ts).alias("pane"), *PAIR).distinct()
        trades = self.store.read("trades").filter(F.col("trade_date").isin(merged.days))
        minute = timedelta(minutes=1)
        near = trades.filter((ts >= at(merged.first - minute)) & (ts <= at(merged.last + minute)))
        inside = near.withColumn("pane", pane_time(ts)).join(touched, keys, "left_semi").drop("pane")
        stored = self.store.read("market_panes").filter(F.col("trade_date").isin(merged.days))
        kept = stored.withColumn("pane", ts).join(touched, keys, "left_anti").drop("pane")
        rows = kept.unionByName(conform(panes(inside), "market_panes", "trade_date"))
        self.store.overwrite_partitions("market_panes", rows)

    def _add_closes(self, merged: Merged) -> None:
        stored = self.store.read("market_closes").filter(F.col("trade_date").isin(merged.days))
        rows = stored.unionByName(conform(rolling.market_closes(merged.rows), "market_closes", "trade_date"))
        last = upsert.last_per_key(rows, ["trade_date", *PAIR], ["close_id"])
        self.store.overwrite_partitions("market_closes", last)

    def _add_asset_closes(self, priced: DataFrame, whole_days: list[date] | None = None) -> None:
        """Last price of each asset per day.  At the same trade the new price counts: it was priced again.  Of
        ``whole_days`` all trades are given, and what was kept does not count."""
        made = priced.filter(F.col("usd_price").isNotNull()).select(
            F.to_date("timestamp").alias("trade_date"), F.col("base_asset_id").alias("asset_id"),
            "usd_price", *pricing.ORDER, F.lit(1).alias("_new"),
        )
        keys = ["trade_date", "asset_id"]
        new = upsert.last_per_key(made, keys, pricing.ORDER)
        stored = self.store.read("asset_closes").withColumn("_new", F.lit(0))
        stored = stored.join(new.select("trade_date").distinct(), "trade_date", "left_semi")
        if whole_days is not None:
            stored = stored.filter(~F.col("trade_date").isin(whole_days))
        last = upsert.last_per_key(stored.unionByName(new), keys, [*pricing.ORDER, "_new"])
        self.store.overwrite_partitions("asset_closes", conform(last, "asset_closes", "trade_date"))

    # --- dashboards -------------------------------------------------------------------------------

    def _rolling_tables(self, as_of: datetime) -> None:
        store = self.store
        assets = store.read("assets")
        rows = store.read("market_panes" if exact_for(as_of) else "trades")
        windows = cut_lineage(rolling.market_windows(rows, as_of))
        closes = store.read("market_closes")
        per_market = rolling.markets_24h(rows, store.read("markets"), assets, as_of, closes=closes, windows=windows)
        per_asset = rolling.assets_24h(rows, assets, store.read("assets_hourly"), as_of, windows=windows)
        days, hours = store.read("exchange_daily"), store.read("exchange_hourly")
        overall = rolling.exchange_24h(rows, days, hours, as_of, windows=windows)
        together(
            lambda: store.replace("markets_24h", per_market),
            lambda: store.replace("assets_24h", per_asset),
            lambda: store.replace("exchange_24h", overall),
        )

    # --- jobs -------------------------------------------------------------------------------------

    def ingest(self, priced: DataFrame, *, reprice: bool = False) -> list[date]:
        """Merge priced trades and bring everything kept along with them up to date; returns the days touched.

        ``priced`` is read several times; the caller passes it checkpointed.
        """
        with self.writing_trades, releasing(self.spark):
            return self.merge(priced, reprice=reprice)

    def merge(self, priced: DataFrame, *, reprice: bool = False, newest: bool = True) -> list[date]:
        """The same for a caller that holds ``writing_trades``.  ``newest``: the prices made are those in force."""
        merged = self.store.merge_trades(priced, reprice=reprice)
        if merged is None:
            return []
        steps = [lambda: self._add_panes(merged), lambda: self._add_closes(merged), lambda: self._add_asset_closes(priced)]
        if newest:
            steps.append(lambda: self.save_trade_prices(priced))
        together(*steps)
        if merged.rewritten:
            self._summarise_days(merged.rewritten)
        self.store.mark_kept(merged.entry)
        return merged.days

    def backfill(self, trades: DataFrame, seeds: DataFrame | None = None) -> None:
        """Load a whole history of admitted trades into empty tables: priced in one go and written once."""
        with self.writing_trades, releasing(self.spark):
            # Pricing reads its input several times: the texts are parsed once.
            staged = cut_lineage(trades)
            days = {row[0] for row in staged.select(F.to_date("timestamp")).distinct().collect()}
            entry = self.store.mark_days(days)
            self._load(pricing.price_trades(upsert.unique_trades(staged), self.config, seeds=seeds))
            self.store.mark_kept(entry)

    def _load(self, priced: DataFrame) -> None:
        dated = priced.withColumn("trade_date", F.to_date("timestamp"))
        store = self.store
        # The price made is written along, so that everything else reads what was written.
        store.overwrite_partitions("trades", conform(dated, "trades", "trade_date"))
        rows = store.read("trades")
        spans = rows.groupBy("trade_date").agg(F.min("trade_id").alias("low"), F.max("trade_id").alias("high"))
        together(
            lambda: store.replace("trade_days", spans),
            lambda: self._summarise_days(None),
            lambda: self._add_asset_closes(rows),
            lambda: self.save_trade_prices(rows),
        )

    def refresh(self, as_of: datetime, landed: Landed) -> Report:
        """Every five minutes."""
        report, today = Report(self.spark), as_of.date()

        def given(part: DataFrame | None, step: Callable[[DataFrame], object]) -> Callable[[], object]:
            return lambda: False if part is None else step(part)

        report.run("assets", given(landed.asset_pages, self.save_listed_assets))
        report.run("markets", given(landed.market_pages, lambda part: self.save_listed_markets(part, as_of)))
        report.run("values", given(landed.balances, self.save_values))
        report.run("fees", given(landed.balances, lambda part: self.save_fees(part, today)))
        report.run("new_day", lambda: self._roll_forward(today))
        report.run("measures", lambda: self.save_measures(landed, today))
        report.run("rolling", lambda: self._rolling_tables(as_of))
        report.run("touched_days", lambda: self.settle_days(today) and None)
        report.run("day", lambda: self._day_tables(today))
        return report

    def hourly(self, as_of: datetime, landed: Landed) -> Report:
        """Every hour."""
        report, store = Report(self.spark), self.store
        hour = hourly.hour_of(as_of)

        def snapshot_assets() -> None:
            store.replace_partition("assets_hourly", hourly.assets_hourly(store.read("assets"), as_of), hour)

        def snapshot_exchange() -> None:
            row = hourly.exchange_hourly(store.read("exchange_daily"), as_of)
            kept = F.col("stat_time") != F.lit(hour)
            self._update("exchange_hourly", lambda stored: stored.filter(kept).unionByName(row))

        report.run("assets_hourly", snapshot_assets)
        report.run("new_day", lambda: self._roll_forward(as_of.date()))
        report.run("exchange_hourly", snapshot_exchange)
        report.run("alltime", self._close_alltime)
        pages = landed.transfer_pages
        report.run("transfers", lambda: False if pages is None else self.save_transfers(pages))
        return report

    def nightly(self, as_of: datetime) -> Report:
        """Shortly after midnight, for the day before."""
        report, store = Report(self.spark), self.store
        today, yesterday = as_of.date(), as_of.date() - timedelta(days=1)

        def close() -> None:
            rows = store.read("market_panes")
            self._update("exchange_daily", lambda days: daily.exchange_daily_close(days, rows, yesterday))

        def settle() -> None:
            with self.writing_trades:
                store.compact_trades(yesterday)
                self._summarise_days([yesterday])

        def clean() -> None:
            with self.writing_trades:
                store.clean_trades(today, self.config.trade_retention_days)

        report.run("settle", settle)
        report.run("close", close)
        report.run("new_day", lambda: self._roll_forward(today))
        report.run("day", lambda: self._day_tables(yesterday))
        report.run("touched_days", lambda: self.settle_days(today) and None)
        report.run("clean_trades", clean)
        report.run("clean_closes", lambda: self._clean_closes(today))
        report.run("compact_transfers", self._compact_transfers)
        report.run("references", self.check_references)
        report.run("clean_hourly", lambda: store.clean_hourly(as_of, self.config.hourly_retention_days))
        report.run("alltime", self._close_alltime)
        return report

    def check_references(self) -> None:
        """Keys of the stored tables that no asset has.  Trades are counted by their sums per minute."""
        store = self.store
        assets = store.read("assets")
        tables = [("trades", "market_panes", "trades"), *[(name, name, None) for name in ("markets", "markets_daily", "markets_24h")]]
        found = [admission.unknown_assets(store.read(kept), assets, name, counted) for name, kept, counted in tables]
        store.replace("orphans", reduce(DataFrame.unionByName, found).coalesce(1))

    def _compact_transfers(self) -> None:
        with self._locks["fee_withdrawals"]:
            self.store.compact_ranges("fee_withdrawals")

    def _clean_closes(self, today: date) -> None:
        """The closes follow the trades: gone days go, the cut day is taken anew."""
        with self.writing_trades:
            self._summarise_days([today - timedelta(days=self.config.trade_retention_days)])

    def update_book(self, pages: DataFrame, as_of: datetime) -> None:
        """Every minute: reconcile the stored book with the newest snapshots and stamp the time.  Only the buckets of
        markets with a snapshot are read and written."""
        rejected = orderbook.rejected_pages(pages)
        if not rejected.isEmpty():
            rejected.write.mode("append").parquet(f"{self.store.root}/quarantine_book")
        pages = orderbook.latest_snapshot(pages)
        levels, markets = orderbook.snapshot_levels(pages), cut_lineage(orderbook.snapshot_markets(pages))
        with self._locks["orderbook"]:
            touched = self.store.buckets_of("orderbook", markets)
            if touched:
                stored = self.store.read_buckets("orderbook", touched)
                self.store.replace_buckets("orderbook", book.apply_snapshot(stored, levels, markets), touched)
        self.store.replace("orderbook_lastupdate", hourly.freshness_stamp(self.spark, as_of))

    def reprice_from(self, day: date) -> list[date]:
        """Price stored trades again from ``day`` on, after late trades arrived, starting from the last
        prices set before that day.  The prices it ends with are kept for the trade streams, whose next
        batch takes them over."""
        with self.writing_trades, releasing(self.spark):
            closes = self.store.read("asset_closes").filter(F.col("trade_date") < F.lit(day))
            seeds = upsert.last_per_key(closes.drop("trade_date"), ["asset_id"], pricing.ORDER)
            trades = self.store.read("trades").filter(F.col("trade_date") >= F.lit(day)).drop("trade_date")
            priced = cut_lineage(pricing.price_trades(trades, self.config, seeds=seeds))
            days = self.ingest(priced, reprice=True)
            self._keep_repriced()
            return days

    def _keep_repriced(self) -> DataFrame:
        """The prices in force after repricing, for the streams."""
        closes = self.store.read("asset_closes").drop("trade_date")
        self.store.replace("repriced_assets", upsert.last_per_key(closes, ["asset_id"], pricing.ORDER))
        return self.store.read("repriced_assets")

    def reprice_late(self, late: DataFrame) -> list[date]:
        """Price again what late trades (stored already; trade_id, base and quote asset, timestamp) change, and no more;
        returns the days.

        A late trade changes its own volume, and the price of its base until the next trade of that asset.  Where
        the base is no quote of any market that is all.  Else the trades quoted in it are priced again, and what
        follows from theirs, day by day until the prices at the end of a day are those of before: then they have met
        again.  Each day reads the trades quoted in such assets, and the ticks of other quote assets as stored.
        """
        with self.writing_trades, releasing(self.spark):
            behind = cut_lineage(late.select("trade_id", *PAIR, F.to_date("timestamp").alias("trade_date")).distinct())
            pairs = cut_lineage(daily.traded_pairs(self.store.read("market_closes")))
            quotes, inner = pricing.quote_markets(pairs, self.config.stable_assets)
            days_late = {row.trade_date for row in behind.select("trade_date").distinct().collect()}
            moved = behind.filter(F.col("base_asset_id").isin(*quotes)).select("trade_date", "base_asset_id").distinct().collect()
            closes = self.store.read("asset_closes").withColumn("_new", F.lit(0))
            carried: dict[str, tuple[float | None, float | None]] = {}
            parts: list[DataFrame] = []
            for day in sorted(d for d in self.store.partitions("trades") if days_late and d >= min(days_late)):
                starts = {row.base_asset_id for row in moved if row.trade_date == day}
                changed = pricing.dependents(starts | set(carried), inner)
                if not changed and day not in days_late:
                    continue
                earlier = closes.filter(F.col("trade_date") < F.lit(day)).drop("trade_date")
                seeds = cut_lineage(upsert.last_per_key(earlier, ["asset_id"], [*pricing.ORDER, "_new"]))
                stored = self.store.read("trades").filter(F.col("trade_date") == F.lit(day)).drop("trade_date")
                on_day = behind.filter(F.col("trade_date") == F.lit(day))
                priced, last = pricing.reprice_day(stored, on_day, changed, quotes, self.config, seeds.drop("_new"))
                parts.append(priced)
                made = cut_lineage(last)
                closes = closes.unionByName(
                    made.filter("new is not null").select(F.col("asset").alias("asset_id"), "new.*").withColumns(
                        {"trade_date": F.lit(day), "_new": F.lit(1)}
                    )
                )
                before = {r.asset_id: r.usd_price for r in seeds.filter(F.col("asset_id").isin(*changed)).collect()}
                carried = _carried(carried, before, {r.asset: (r.old, r.new) for r in made.collect()})
            if not parts:
                return []
            priced = cut_lineage(reduce(DataFrame.unionByName, parts))
            days = self.merge(priced, reprice=True, newest=False)
            self._keep_repriced()
            self.save_prices_in_force(priced)
            return days


def _carried(
    carried: dict[str, tuple[float | None, float | None]],
    before: dict[str, float],
    last: dict[str, tuple[Row | None, Row | None]],
) -> dict[str, tuple[float | None, float | None]]:
    """Assets whose price at the end of a day is not the one it would have been, as (old, new), from those of the day
    before, the prices at its start and the last ticks (old, new) of the day."""
    after = dict(carried)
    for asset, (old, new) in last.items():
        was, now = carried.get(asset, (before.get(asset), before.get(asset)))
        after[asset] = (old.usd_price if old else was, new.usd_price if new else now)

    def met(old: float | None, new: float | None) -> bool:
        # Along a cycle prices are multiplied in another order; the last digits may differ.
        return old == new or (old is not None and new is not None and abs(old - new) <= 1e-12 * abs(old))

    return {asset: prices for asset, prices in after.items() if not met(*prices)}

