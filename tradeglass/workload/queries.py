"""One query per operator, over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.dates import DAY, at, in_current, in_previous
from tradeglass.functions.numeric import floor_amount
from tradeglass.operators import admission, book, daily, hourly, lastknown, listing, pricing, rolling, upsert, values
from tradeglass.operators.activity import PAIR
from tradeglass.plans.jobs import Jobs
from tradeglass.plans.store import BUCKETED, Store
from tradeglass.schemas import PRICE, VOLUME, conform, schema_of
from tradeglass.session import cut_lineage
from tradeglass.sources import chain, listings, orderbook
from tradeglass.sources.trades import parse_events, stream_events
from tradeglass.streaming import windows
from tradeglass.streaming.trades import TradeStream
from tradeglass.workload.inputs import AS_OF, CONFIG, TODAY, Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRADE_COLUMNS = [
    "trade_id", "base_asset_id", "quote_asset_id", "price", "quantity", "volume_quote", "volume", "timestamp"
]
LISTING = ExchangeConfig(native_asset="A00", stable_assets=("0",))
RETENTION_DAY = date(2024, 3, 15)
LATENESS = "1 hour"
# Rows of a page of transfers, where pages are asked for.
PAGE_ROWS = 100


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# --- sources --------------------------------------------------------------------------------------


@query
def src_trades(data: Inputs) -> DataFrame:
    return parse_events(data.event_texts())


@query
def asset_listing(data: Inputs) -> DataFrame:
    return listings.asset_listing(data.asset_pages(), LISTING)


@query
def market_listing(data: Inputs) -> DataFrame:
    known = listings.asset_listing(data.asset_pages(), LISTING)
    return listings.market_listing(data.market_pages(), known, LISTING)


@query
def market_split(data: Inputs) -> DataFrame:
    pages = data.market_pages()
    return listings.split_markets(pages.select(F.explode("items.market").alias("market")))


@query
def orderbook_snapshot(data: Inputs) -> DataFrame:
    return orderbook.snapshot_levels(orderbook.latest_snapshot(data.book_pages())).drop("level_id")


@query
def orderbook_failed_pages(data: Inputs) -> DataFrame:
    """Newest complete snapshots where some pages failed or cannot be read."""
    return orderbook.snapshot_levels(orderbook.latest_snapshot(data.book_pages_with_failures())).drop("level_id")


@query
def wallet_balances(data: Inputs) -> DataFrame:
    balances, assets = data.balances(), data.assets()
    parts = [
        chain.wallet_balances(balances, assets, wallet).select(F.lit(wallet).alias("wallet"), "asset_id", "balance_raw")
        for wallet in (CONFIG.pool_wallet, CONFIG.fee_wallet, CONFIG.treasury_wallet)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def metric_latest(data: Inputs) -> DataFrame:
    return chain.latest_metrics(data.metric_envelopes())


@query
def stakers_by_role(data: Inputs) -> DataFrame:
    return chain.role_count(data.role_payloads()).drop("observed_at")


@query
def transfers_after_cursor(data: Inputs) -> DataFrame:
    return chain.transfers_after(chain.transfers(data.transfer_pages()), 0, 4)


@query
def transfers_next_page(data: Inputs) -> DataFrame:
    return chain.transfers_after(chain.transfers(data.transfer_pages()), 20, 4, PAGE_ROWS)


@query
def cursor_advance(data: Inputs) -> DataFrame:
    stored = chain.cursor_rows(chain.transfers(data.transfer_pages()).filter("block_num < 1"))
    return upsert.upsert_metadata(stored, chain.cursor_rows(chain.transfers(data.transfer_pages())))


@query
def book_scan(data: Inputs) -> DataFrame:
    return orderbook.book_of(data.book(), "S7", "USDT", BUCKETED["orderbook"][1])


@query
def asset_price_scan(data: Inputs) -> DataFrame:
    return data.asset_prices().select("asset_id", "price")


@query
def bulk_sink(data: Inputs) -> DataFrame:
    """Write all trades to day partitions and read them back."""
    store = Store(data.spark, data.scratch("sink"), rows_per_file=10_000)
    rows = data.trades()
    store.overwrite_partitions("trades", rows)
    return store.read("trades").select("trade_date", *TRADE_COLUMNS)


# --- filters and change detection -----------------------------------------------------------------


@query
def admitted_trades(data: Inputs) -> DataFrame:
    return data.admitted().select(*[c for c in TRADE_COLUMNS if c != "volume"])


@query
def window_boundary(data: Inputs) -> DataFrame:
    """Which window each trade falls into, at a moment that is itself the time of a trade."""
    trades = data.trades()
    ts = F.col("timestamp")
    edge = trades.filter(ts <= at(AS_OF)).agg(F.max("timestamp")).first()[0]
    inside = F.when(in_current(ts, edge + DAY), "current").when(in_previous(ts, edge + DAY), "previous")
    return trades.select("trade_id", "timestamp", inside.alias("in_window"))


@query
def price_changes(data: Inputs) -> DataFrame:
    return pricing.price_changes(data.trades(), CONFIG)


@query
def price_carry_forward(data: Inputs) -> DataFrame:
    refreshes = data.trade_source().select(
        F.col("base_asset_id").alias("asset_id"),
        "timestamp",
        "trade_id",
        F.when(F.col("event_type").isin("purchase", "signup"), F.col("price")).alias("price"),
    )
    return pricing.price_carry_forward(refreshes, CONFIG)


# --- joins ----------------------------------------------------------------------------------------


@query
def asof_latest_before(data: Inputs) -> DataFrame:
    hours = data.assets_hourly()
    return lastknown.latest_before(hours, ["asset_id"], "stat_time", at(AS_OF - DAY), ["price", "tvl", "fees"])


@query
def idle_assets(data: Inputs) -> DataFrame:
    return daily.idle_assets(data.assets(), data.trades(), TODAY).select("asset_id", "symbol")


@query
def idle_markets(data: Inputs) -> DataFrame:
    return daily.idle_markets(data.markets(), data.closes())


@query
def orphan_keys(data: Inputs) -> DataFrame:
    """The four tables that refer to assets, blocked ones included, against the listed assets."""
    trades, assets = data.trade_source(), data.assets()
    pairs = trades.select(*PAIR).distinct()
    tables = {
        "trades": trades,
        "markets": data.markets().unionByName(pairs).distinct(),
        "markets_daily": trades.select(F.to_date("timestamp").alias("stat_date"), *PAIR).distinct(),
        "markets_24h": trades.filter(F.col("timestamp") > at(AS_OF - DAY)).select(*PAIR).distinct(),
    }
    parts = [admission.unknown_assets(rows, assets, name) for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def orphan_keys_stored(data: Inputs) -> DataFrame:
    """Two assets are no longer listed: their keys in the four stored tables; of trades their sums are read."""
    store = data.late_store()
    jobs = Jobs(Store(data.spark, data.scratch("orphans")), CONFIG)
    jobs.store.replace("assets", store.read("assets").filter(~F.col("asset_id").isin("A07", "A98")))
    jobs.store.replace("markets", store.read("markets"))
    jobs.store.replace("markets_24h", store.read("markets_24h"))
    jobs.store.overwrite_partitions("markets_daily", store.read("markets_daily"))
    jobs.store.overwrite_partitions("market_panes", store.read("market_panes"))
    jobs.check_references()
    return jobs.store.read("orphans")


@query
def market_history(data: Inputs) -> DataFrame:
    """Since when and until when markets were listed, from a listing a day."""
    listed = data.listings()
    moments = data.admitted().select(F.date_trunc("day", "timestamp").alias("taken_at"))
    return listing.listing_history(listed, moments)


@query
def replayed_trades(data: Inputs) -> DataFrame:
    """Trades of the past that a replay admits: their market was listed when they happened."""
    moments = data.admitted().select(F.date_trunc("day", "timestamp").alias("taken_at"))
    history = listing.listing_history(data.listings(), moments)
    return listing.admitted_as_of(data.trade_source(), history, CONFIG).select(*[c for c in TRADE_COLUMNS if c != "volume"])


# --- roll-ups -------------------------------------------------------------------------------------


@query
def markets_daily(data: Inputs) -> DataFrame:
    """From the trades of the day, and the pairs ever traded from the closes."""
    return daily.markets_daily(data.trades(), data.markets(), TODAY, traded=daily.traded_pairs(data.closes()))


@query
def markets_daily_from_panes(data: Inputs) -> DataFrame:
    return daily.markets_daily(data.panes(), data.markets(), TODAY, traded=daily.traded_pairs(data.closes()))


@query
def assets_daily(data: Inputs) -> DataFrame:
    return daily.assets_daily(data.trades(), data.asset_state(), TODAY)


@query
def assets_daily_compat(data: Inputs) -> DataFrame:
    return daily.assets_daily(data.trades(), data.asset_state(), TODAY, compat=True)


@query
def markets_24h(data: Inputs) -> DataFrame:
    """From sums per minute and last trades per day, as the refresh job does it."""
    return rolling.markets_24h(data.panes(), data.markets(), data.assets(), AS_OF, closes=data.closes())


@query
def markets_24h_from_closes(data: Inputs) -> DataFrame:
    """The same from the trades of three days, older prices taken from the last trades per day."""
    return rolling.markets_24h(data.trades(), data.markets(), data.assets(), AS_OF, closes=data.closes())


@query
def markets_24h_from_panes(data: Inputs) -> DataFrame:
    """The same with windows made first, as the dashboards of one refresh share them."""
    windows = rolling.market_windows(data.panes(), AS_OF)
    return rolling.markets_24h(data.panes(), data.markets(), data.assets(), AS_OF, closes=data.closes(), windows=windows)


@query
def assets_24h(data: Inputs) -> DataFrame:
    return rolling.assets_24h(data.trades(), data.asset_state(), data.assets_hourly(), AS_OF)


@query
def exchange_24h(data: Inputs) -> DataFrame:
    return rolling.exchange_24h(data.trades(), data.exchange_daily(), data.exchange_hourly(), AS_OF)


@query
def exchange_daily_close(data: Inputs) -> DataFrame:
    return daily.exchange_daily_close(data.exchange_daily(), data.trades(), TODAY)


@query
def exchange_daily_measures(data: Inputs) -> DataFrame:
    users = data.table("events").agg(
        F.count_distinct("user_id").alias("users"),
        F.lit(None).cast("bigint").alias("total_holders"),
        F.count(F.lit(1)).alias("total_stakers"),
    )
    return daily.exchange_daily_measures(data.exchange_daily(), data.asset_state(), users, TODAY)


@query
def exchange_alltime(data: Inputs) -> DataFrame:
    return daily.exchange_alltime(data.exchange_daily())


@query
def latest_day(data: Inputs) -> DataFrame:
    return daily.previous_users(data.exchange_daily(), TODAY)


@query
def new_day_rollforward(data: Inputs) -> DataFrame:
    """The last day present with gaps is filled, then the day after it is inserted."""
    filled = daily.new_day_rollforward(data.exchange_daily(), TODAY)
    return daily.new_day_rollforward(filled, TODAY + DAY)


@query
def assets_hourly(data: Inputs) -> DataFrame:
    return hourly.assets_hourly(data.asset_state(), AS_OF + timedelta(minutes=8))


@query
def exchange_hourly(data: Inputs) -> DataFrame:
    return hourly.exchange_hourly(data.exchange_daily(), AS_OF + timedelta(minutes=8))


@query
def day_replace(data: Inputs) -> DataFrame:
    """The last day of the stored history written again from the trades."""
    store = Store(data.spark, data.scratch("days"))
    store.overwrite_partitions("assets_daily", data.assets_daily())
    rows = daily.assets_daily(data.trades(), data.asset_state(), TODAY)
    store.replace_partition("assets_daily", rows, TODAY)
    return store.read("assets_daily")


@query
def late_markets_daily(data: Inputs) -> DataFrame:
    """Day rows of all markets after some trades came late and their days were taken anew."""
    return data.late_store().read("markets_daily")


@query
def late_assets_daily(data: Inputs) -> DataFrame:
    return data.late_store().read("assets_daily")


@query
def late_exchange_daily(data: Inputs) -> DataFrame:
    return data.late_store().read("exchange_daily")


@query
def late_alltime(data: Inputs) -> DataFrame:
    return data.late_store().read("exchange_alltime").select("volume", "trades")


@query
def retained_trades(data: Inputs) -> DataFrame:
    return hourly.retained_trades(data.trades(), RETENTION_DAY).select("trade_id", "timestamp")


@query
def retained_hourly(data: Inputs) -> DataFrame:
    return hourly.retained_hourly(data.assets_hourly(), AS_OF).select("stat_time", "asset_id", "price")


# --- prices and values ----------------------------------------------------------------------------


@query
def priced_trades(data: Inputs) -> DataFrame:
    return data.price().select(*TRADE_COLUMNS)


@query
def market_last_price(data: Inputs) -> DataFrame:
    return pricing.market_last_price(data.trades())


@query
def asset_last_price(data: Inputs) -> DataFrame:
    last = pricing.asset_last_price(data.priced())
    return last.select("asset_id", F.col("usd_price").cast(PRICE).alias("price"), "timestamp", "trade_id")


@query
def asset_tvl(data: Inputs) -> DataFrame:
    prices = data.asset_prices()
    return values.asset_tvl(prices, chain.wallet_balances(data.balances(), prices, CONFIG.pool_wallet))


@query
def fee_withdrawals_by_asset(data: Inputs) -> DataFrame:
    return values.fee_withdrawals_by_asset(data.withdrawals(), data.assets())


@query
def asset_fees(data: Inputs) -> DataFrame:
    prices = data.asset_prices()
    held = chain.wallet_balances(data.balances(), prices, CONFIG.fee_wallet)
    return values.asset_fees(prices, held, data.withdrawals(), data.assets_daily(), TODAY)


@query
def fee_deltas(data: Inputs) -> DataFrame:
    return values.fee_deltas(data.assets_daily())


@query
def user_deltas(data: Inputs) -> DataFrame:
    return values.user_deltas(data.exchange_daily())


@query
def treasury_metrics(data: Inputs) -> DataFrame:
    prices = data.asset_prices()
    treasury = chain.wallet_balances(data.balances(), prices, CONFIG.treasury_wallet)
    return values.treasury_metrics(chain.latest_scalars(data.scalars()), treasury, prices, CONFIG)


@query
def scaled_amounts(data: Inputs) -> DataFrame:
    raw = F.expr("cast(cast(c_acctbal as decimal(12,2)) * 100 as bigint) * 12345678 + c_custkey")
    return data.table("customer").select(
        "c_custkey",
        floor_amount(raw, 6).alias("balance"),
        floor_amount(raw, 2).alias("readable"),
    )


# --- merges ---------------------------------------------------------------------------------------


@query
def upsert_trades(data: Inputs) -> DataFrame:
    """Stored trades of three kinds of event, merged with two versions of each trade of two kinds."""
    tagged = data.trades().join(data.trade_source().select("trade_id", "event_type"), "trade_id")
    target = tagged.filter(F.col("event_type") != "signup").select(*TRADE_COLUMNS)
    first = tagged.filter(F.col("event_type").isin("purchase", "signup")).select(*TRADE_COLUMNS)
    second = first.withColumns(
        {
            "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 SECOND"),
            "quantity": (F.col("quantity") + 1).cast(PRICE),
            "volume": F.lit(None).cast(VOLUME),
        }
    )
    return upsert.upsert_trades(target, first.unionByName(second))


@query
def merge_trades(data: Inputs) -> DataFrame:
    """The same merge as the ingest job does it: new ids are appended, days of changed trades rewritten."""
    trades = data.trades().drop("trade_date")
    kinds = data.trade_source().select("trade_id", "event_type")
    tagged = cut_lineage(trades.join(kinds, "trade_id"))
    second = tagged.filter(F.col("event_type").isin("purchase", "signup")).withColumns(
        {
            "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 SECOND"),
            "quantity": (F.col("quantity") + 1).cast(PRICE),
            "volume": F.lit(None).cast(VOLUME),
        }
    )
    store = Store(data.spark, data.scratch("merged"))
    store.merge_trades(tagged.filter(F.col("event_type") != "signup").drop("event_type"))
    store.merge_trades(second.drop("event_type"))
    return store.read("trades").select(*TRADE_COLUMNS)


@query
def upsert_assets_nullsafe(data: Inputs) -> DataFrame:
    """Parts as stored assets, merged with figures of their line items (some of them null)."""
    lines = data.table("lineitem").groupBy(F.col("l_partkey").alias("key")).agg(
        F.max("l_extendedprice").alias("top"), F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("n")
    )
    odd = F.col("n") % 2 == 1

    def cents(name: str):
        return F.col(name).cast("decimal(18,2)")

    def rows(frame: DataFrame, **columns) -> DataFrame:
        empty = {f.name: F.lit(None) for f in schema_of("assets")}
        return conform(frame.select(*[c.alias(n) for n, c in (empty | columns).items()]), "assets")

    target = rows(
        data.table("part"),
        asset_id=F.col("p_partkey").cast("string"), symbol=F.col("p_brand"), name=F.col("p_name"),
        is_active=F.lit(True), price=cents("p_retailprice"), balance=F.col("p_size"),
    )
    source = rows(
        lines,
        asset_id=F.col("key").cast("string"), symbol=F.lit("LINE"), name=F.when(odd, "odd").otherwise("even"),
        is_active=F.lit(True), price=F.when(odd, cents("top")), tvl=cents("total"),
        balance=F.when(~odd, F.col("n")),
    )
    return upsert.upsert_assets(target, source)


@query
def upsert_markets(data: Inputs) -> DataFrame:
    """Listed markets get the last trade price; a refresh without prices keeps it."""
    listed = data.markets().select(*PAIR, F.lit(True).alias("is_active"), F.lit(None).cast(PRICE).alias("price"))
    traded = pricing.market_last_price(data.trades()).withColumn("is_active", F.lit(True)).select(*listed.columns)
    return upsert.upsert_markets(upsert.upsert_markets(listed, traded), listed)


def _deliveries(data: Inputs) -> tuple[DataFrame, DataFrame]:
    """Transfers stored so far, and a second delivery of everything: all twice, some incomplete."""
    orders = data.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    rows = chain.transfers(data.transfer_pages()).join(orders, F.col("transfer_id") == F.col("o_orderkey"))
    stored = rows.filter(F.col("o_orderstatus") == "F")
    priority = F.col("o_orderpriority")
    again = rows.withColumns(
        {
            "amount": F.when(priority != "5-LOW", F.col("amount")),
            "asset_symbol": F.when(priority == "2-HIGH", "").otherwise(F.col("asset_symbol")),
        }
    )
    later = again.withColumns({"block_num": F.col("block_num") + 1, "amount": (F.col("amount") + 1).cast(PRICE)})
    return stored, again.unionByName(later)


TRANSFER_COLUMNS, TRANSFER_ORDER = ["transfer_id", "asset_symbol", "amount"], ["block_num", "event_idx"]


@query
def insert_ignore_transfers(data: Inputs) -> DataFrame:
    """Transfers stored so far, and those of a second delivery that are new and complete."""
    stored, again = _deliveries(data)
    stored = conform(stored, "fee_withdrawals")
    return stored.unionByName(upsert.insert_new(stored, again, "transfer_id", TRANSFER_COLUMNS, TRANSFER_ORDER))


@query
def insert_ignore_ranges(data: Inputs) -> DataFrame:
    """The same as the job does it: ids are looked for in the ranges of ids that a delivery falls into, then its
    transfers are appended; ranges of many files are written anew."""
    store = Store(data.spark, data.scratch("transfers"))
    for delivery in _deliveries(data):
        store.append_new("fee_withdrawals", delivery, TRANSFER_COLUMNS, TRANSFER_ORDER)
    store.compact_ranges("fee_withdrawals", files=1)
    return store.read("fee_withdrawals").select(*TRANSFER_COLUMNS)


@query
def orderbook_diff(data: Inputs) -> DataFrame:
    pages = data.snapshot(2)
    return book.book_changes(data.book(), orderbook.snapshot_levels(pages), orderbook.snapshot_markets(pages))


@query
def orderbook_apply(data: Inputs) -> DataFrame:
    pages = data.snapshot(2)
    return book.apply_snapshot(data.book(), orderbook.snapshot_levels(pages), orderbook.snapshot_markets(pages))


@query
def orderbook_job(data: Inputs) -> DataFrame:
    """Both snapshots reconciled one after the other by the job, with the time of the last update."""
    store = Store(data.spark, data.scratch("book"))
    jobs = Jobs(store, CONFIG)
    for number in (1, 2):
        jobs.update_book(data.snapshot(number), AS_OF + timedelta(minutes=number))
    stamp = store.read("orderbook_lastupdate").select("last_update").scalar()
    return store.read("orderbook").withColumn("last_update", stamp)


@query
def orderbook_few_markets(data: Inputs) -> DataFrame:
    """The book after a second snapshot of a few markets only: the buckets of the others stay as they are."""
    store = Store(data.spark, data.scratch("few"))
    jobs = Jobs(store, CONFIG)
    jobs.update_book(data.snapshot(1), AS_OF)
    jobs.update_book(data.snapshot(2).filter(F.col("market").isin("S5-USDT", "S7-USDT")), AS_OF + timedelta(minutes=1))
    return store.read("orderbook")


# --- streaming ------------------------------------------------------------------------------------


@query
def stream_priced_trades(data: Inputs) -> DataFrame:
    """Event texts landed in three parts, each priced by one run of the stream from the state before."""
    root = data.scratch("stream")
    jobs = Jobs(Store(data.spark, f"{root}/tables"), CONFIG)
    jobs.store.replace("assets", conform(_unpriced(data.assets()), "assets"))
    listed = data.markets().withColumns({"is_active": F.lit(True), "price": F.lit(None)})
    jobs.store.replace("markets", conform(listed, "markets"))
    texts = data.event_texts()
    edges = [datetime(1970, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2100, 1, 1)]
    stream = TradeStream(jobs)
    for first, last in zip(edges, edges[1:]):
        part = texts.filter((F.col("timestamp") >= at(first)) & (F.col("timestamp") < at(last)))
        part.select("value").write.mode("append").text(f"{root}/events")
        stream.start(stream_events(data.spark, f"{root}/events"), f"{root}/checkpoint").awaitTermination()
    return jobs.store.read("trades").select(*TRADE_COLUMNS)


@query
def stream_repriced_trades(data: Inputs) -> DataFrame:
    """Event texts of which one part comes late: after it the trades are priced again, and the last part starts
    from the prices that left."""
    root = data.scratch("repriced")
    jobs = Jobs(Store(data.spark, f"{root}/tables"), CONFIG)
    jobs.store.replace("assets", conform(_unpriced(data.assets()), "assets"))
    listed = data.markets().withColumns({"is_active": F.lit(True), "price": F.lit(None)})
    jobs.store.replace("markets", conform(listed, "markets"))
    texts, moment = data.event_texts(), F.col("timestamp")
    late = moment.between(at(datetime(2024, 1, 11)), at(datetime(2024, 1, 13, 23, 59, 59)))
    last = moment >= at(datetime(2024, 1, 21))
    stream = TradeStream(jobs)
    for part in (~late & ~last, late, last):
        texts.filter(part).select("value").write.mode("append").text(f"{root}/events")
        stream.start(stream_events(data.spark, f"{root}/events"), f"{root}/checkpoint").awaitTermination()
        if part is late:
            jobs.reprice_from(date(2024, 1, 11))
    return jobs.store.read("trades").select(*TRADE_COLUMNS)


@query
def stream_late_trades(data: Inputs) -> DataFrame:
    """The same without that: the stream itself prices again what the late trades change, and nothing else."""
    root = data.scratch("followed")
    jobs = Jobs(Store(data.spark, f"{root}/tables"), CONFIG)
    jobs.store.replace("assets", conform(_unpriced(data.assets()), "assets"))
    listed = data.markets().withColumns({"is_active": F.lit(True), "price": F.lit(None)})
    jobs.store.replace("markets", conform(listed, "markets"))
    texts, moment = data.event_texts(), F.col("timestamp")
    late = (F.to_date(moment) == F.lit(date(2024, 1, 11))) & (F.unix_seconds(moment) % 3 == 0)
    stream = TradeStream(jobs, follow_late=True)
    for part in (~late, late):
        texts.filter(part).select("value").write.mode("append").text(f"{root}/events")
        stream.start(stream_events(data.spark, f"{root}/events"), f"{root}/checkpoint").awaitTermination()
    return jobs.store.read("trades").select(*TRADE_COLUMNS)


def _unpriced(assets: DataFrame) -> DataFrame:
    figures = [f.name for f in schema_of("assets") if f.name not in assets.columns]
    return assets.withColumns({name: F.lit(None) for name in figures})


def _trade_stream(data: Inputs) -> DataFrame:
    path = f"{data.store().root}/trades"
    return data.spark.readStream.schema(data.trades().schema).parquet(path)


def _streamed(data: Inputs, rows: DataFrame, name: str) -> DataFrame:
    root = data.scratch(name)
    windows.append_to(rows, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return data.spark.read.schema(rows.schema).parquet(f"{root}/rows")


@query
def stream_daily_windows(data: Inputs) -> DataFrame:
    """Closed days of the trade stream."""
    return _streamed(data, windows.tumbling(windows.once(_trade_stream(data), LATENESS), "1 day"), "days")


@query
def stream_sliding_24h(data: Inputs) -> DataFrame:
    """Closed 24-hour windows of the trade stream, one per hour."""
    rows = windows.sliding(windows.once(_trade_stream(data), LATENESS), "24 hours", "1 hour")
    return _streamed(data, rows, "sliding")
