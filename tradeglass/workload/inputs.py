"""Benchmark tables mapped onto exchange inputs.

``events`` become trades, ``customer`` and ``supplier`` wallet balances, ``orders`` fee transfers and
metrics, ``lineitem`` the order book, ``part`` a listing.  Every mapping keeps all rows and is
row-local unless it says otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradeglass.config import ExchangeConfig
from tradeglass.functions.numeric import floor_amount
from tradeglass.operators import pricing, rolling
from tradeglass.operators.activity import PAIR, panes
from tradeglass.operators.admission import admitted_trades
from tradeglass.operators.rolling import market_closes
from tradeglass.plans.jobs import Jobs
from tradeglass.plans.store import Store
from tradeglass.schemas import BALANCE, FEES, PRICE, USD, VOLUME, conform
from tradeglass.session import cut_lineage, prepare, scratch_dir
from tradeglass.sources import chain
from tradeglass.sources.orderbook import snapshot_levels

AS_OF = datetime(2024, 1, 30, 12, 0, 0)
TODAY = date(2024, 1, 30)
CONFIG = ExchangeConfig(native_asset="A00", blocked_assets=("456",), stable_assets=("USDT",))

_landed: dict[tuple[str, str, str], str] = {}
# Names of the tables that are written once per session.
STORED: list[str] = []


def stored(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """A table the jobs keep: written once per session, then read back."""
    STORED.append(build.__name__)

    @wraps(build)
    def read(self: Inputs) -> DataFrame:
        return self.landed(build.__name__, lambda: build(self))

    return read


class Inputs:
    """Inputs derived from the tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new folder for one run."""
        return f"{scratch_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    # --- trades -----------------------------------------------------------------------------------

    def trade_source(self) -> DataFrame:
        """All events as trades, blocked ones included, with the user who caused them."""
        base = _asset_code("user_id")
        kind = F.col("event_type")
        quote = (
            F.when(kind == "error", "456")
            .when((kind == "purchase") & (base != "A00"), "A00")
            .when((kind == "signup") & ~base.isin("A00", "A01"), "A01")
            .otherwise("USDT")
        )
        price = ((F.col("value").cast("decimal(12,2)") + F.expr("0.01")) * F.expr("0.01")).cast("decimal(14,4)")
        quantity = F.get_json_object("props", "$.k").cast("int") + 1
        moment = F.col("ts").cast("timestamp")
        text = F.col("event_id").cast("string")
        return self.table("events").select(
            F.col("event_id").alias("trade_id"),
            "user_id",
            "event_type",
            base.alias("base_asset_id"),
            quote.alias("quote_asset_id"),
            price.cast(PRICE).alias("price"),
            quantity.cast(PRICE).alias("quantity"),
            (price * quantity.cast("decimal(4,0)")).cast(PRICE).alias("volume_quote"),
            F.date_trunc("second", moment + F.expr("INTERVAL 500 MILLISECONDS")).alias("timestamp"),
            F.unix_millis(moment).alias("t"),
            F.concat(F.lit("M"), text).alias("m_id"),
            F.concat(F.lit("T"), text).alias("t_id"),
            F.concat(F.lit("MC"), F.col("user_id").cast("string")).alias("m_cid"),
            F.concat(F.lit("TC"), F.col("user_id").cast("string")).alias("t_cid"),
            F.when(kind.isin("purchase", "view"), "Ask").otherwise("Bid").alias("m_side"),
            F.when(kind.isin("purchase", "view"), "Bid").otherwise("Ask").alias("t_side"),
            F.concat(F.lit("O"), text).alias("trade_oid"),
        )

    def landed(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A payload dataset as it lies in the landing zone.  Written once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _landed:
            path = self.scratch(name)
            build().write.parquet(path)
            _landed[key] = path
        return self.spark.read.parquet(_landed[key])

    @stored
    def event_texts(self) -> DataFrame:
        """The same trades as event texts, with the time they happened."""
        event = F.struct(
            F.lit("TradeEvent").alias("type"),
            F.concat_ws("-", *PAIR).alias("m"),
            F.col("price").cast("string").alias("p"),
            F.col("quantity").cast("string").alias("q"),
            F.col("volume_quote").cast("string").alias("vq"),
            "t",
            F.col("trade_id").alias("stid"),
            F.col("trade_oid").alias("trade_id"),
            *("m_id", "t_id", "m_cid", "t_cid", "m_side", "t_side"),
        )
        return self.trade_source().select("timestamp", F.to_json(event).alias("value"))

    @stored
    def markets(self) -> DataFrame:
        """Pairs that occur and are not blocked, and one that never trades."""
        seen = self.trade_source().select(*PAIR).distinct()
        listed = seen.filter(~F.col("quote_asset_id").isin(*CONFIG.blocked_assets))
        idle = seen.agg(F.lit("A98").alias("base_asset_id"), F.lit("USDT").alias("quote_asset_id"))
        return listed.unionByName(idle)

    def listings(self) -> DataFrame:
        """A listing at the start of each day: the markets with a trade of an even id that day."""
        trades = self.admitted().filter(F.col("trade_id") % 2 == 0)
        return trades.select(*PAIR, F.date_trunc("day", "timestamp").alias("taken_at")).distinct()

    def admitted(self) -> DataFrame:
        return admitted_trades(self.trade_source(), self.markets(), CONFIG)

    def price(self) -> DataFrame:
        """Admitted trades with USD volume and the price they set, computed now."""
        return pricing.price_trades(self.admitted(), CONFIG)

    def store(self) -> Store:
        """The trades as the ingest job leaves them: priced, in day partitions, with the panes and closes kept
        along.  Written once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "trades")
        if key not in _landed:
            store = Store(self.spark, self.scratch("landed"))
            priced = self.price().withColumn("trade_date", F.to_date("timestamp"))
            store.overwrite_partitions("trades", conform(priced, "trades", "trade_date", "user_id"))
            minutes = panes(store.read("trades"))
            store.overwrite_partitions("market_panes", conform(minutes, "market_panes", "trade_date"))
            closes = market_closes(store.read("market_panes"))
            store.overwrite_partitions("market_closes", conform(closes, "market_closes", "trade_date"))
            _landed[key] = store.root
        return Store(self.spark, _landed[key])

    def late_store(self) -> Store:
        """Tables of a history of which half of one day's trades came late: the day tables were closed without them, the
        trades merged and priced again, and the days they touched taken anew.  Written once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "late")
        if key not in _landed:
            jobs = Jobs(Store(self.spark, self.scratch("late")), CONFIG)
            store, day, tomorrow = jobs.store, date(2024, 1, 10), date(2024, 1, 31)
            listed = self.markets().withColumns({"is_active": F.lit(True), "price": F.lit(None)})
            store.replace("markets", conform(listed, "markets"))
            store.replace("exchange_daily", self.exchange_daily())
            admitted = self.admitted()
            late = (F.to_date("timestamp") == F.lit(day)) & (F.col("trade_id") % 2 == 0)
            jobs.backfill(admitted.filter(~late))
            store.replace("assets", self.asset_state())
            jobs.settle_days(tomorrow)
            jobs.ingest(cut_lineage(pricing.price_trades(admitted.filter(late), CONFIG)))
            jobs.reprice_from(day)
            jobs.settle_days(tomorrow)
            panes, closes = store.read("market_panes"), store.read("market_closes")
            assets, markets = store.read("assets"), store.read("markets")
            store.replace("markets_24h", rolling.markets_24h(panes, markets, assets, AS_OF, closes=closes))
            _landed[key] = store.root
        return Store(self.spark, _landed[key])

    def trades(self) -> DataFrame:
        return self.store().read("trades")

    def panes(self) -> DataFrame:
        return self.store().read("market_panes")

    def closes(self) -> DataFrame:
        return self.store().read("market_closes")

    def priced(self) -> DataFrame:
        """Stored trades with the price each one set and its user."""
        return self.spark.read.parquet(f"{self.store().root}/trades")

    # --- assets -----------------------------------------------------------------------------------

    @stored
    def assets(self) -> DataFrame:
        """Every asset that occurs, the idle one included, blocked ones not; names come from ``part``."""
        legs = self.trade_source().select(*PAIR).distinct()
        ids = legs.select(F.explode(F.array(*PAIR, F.lit("A98"))).alias("asset_id")).distinct()
        ids = ids.filter(~F.col("asset_id").isin(*CONFIG.blocked_assets))
        number = F.expr("try_cast(substr(asset_id, 2) as bigint)")
        names = self.table("part").select(F.col("p_partkey").alias("number"), "p_name")
        symbol = F.concat(F.lit("SYM"), (F.col("number") % 10).cast("string"))
        return ids.withColumn("number", number).join(names, "number", "left").select(
            "asset_id",
            F.coalesce(symbol, "asset_id").alias("symbol"),
            F.coalesce("p_name", "asset_id").alias("name"),
            F.lit(True).alias("is_active"),
        )

    @stored
    def asset_prices(self) -> DataFrame:
        """Assets with their last price; the stable one at its pinned price, the idle one without."""
        last = pricing.asset_last_price(self.priced()).select("asset_id", "usd_price")
        pinned = F.when(F.col("asset_id").isin(*CONFIG.stable_assets), F.lit(CONFIG.stable_price))
        return self.assets().join(last, "asset_id", "left").select(
            "asset_id", "symbol", "name", "is_active",
            F.coalesce(F.col("usd_price").cast(PRICE), pinned.cast(PRICE)).alias("price"),
        )

    @stored
    def asset_state(self) -> DataFrame:
        """The asset table: price, pool balance and its value, fees of the fee wallet."""
        prices = self.asset_prices()
        pool = chain.wallet_balances(self.balances(), prices, CONFIG.pool_wallet).withColumnRenamed("balance_raw", "pool")
        fees = chain.wallet_balances(self.balances(), prices, CONFIG.fee_wallet).withColumnRenamed("balance_raw", "held")
        joined = prices.join(pool, "asset_id").join(fees, "asset_id")
        joined = joined.withColumns(
            {"balance": floor_amount(F.col("pool"), 6), "fees": floor_amount(F.col("held"), 6).cast(FEES)}
        )
        joined = joined.withColumn("new_fees", (F.col("fees") * F.expr("0.1")).cast(FEES))
        return conform(
            joined.withColumns(
                {
                    "tvl": (F.col("balance") * F.col("price")).cast(USD),
                    "fees_value": (F.col("fees") * F.col("price")).cast(USD),
                    "new_fees_value": (F.col("new_fees") * F.col("price")).cast(USD),
                }
            ),
            "assets",
        )

    # --- balances, transfers, metrics -------------------------------------------------------------

    @stored
    def balances(self) -> DataFrame:
        """Pool balances summed from ``customer``, fee balances from ``supplier``, treasury from ``orders``."""

        def wallet(name: str, table: str, asset: Column, amount: str) -> DataFrame:
            raw = F.col(amount).cast("decimal(18,2)") * F.expr("cast(1000000000 as decimal(10,0))")
            summed = self.table(table).groupBy(asset.alias("asset_id")).agg(F.sum(raw).alias("raw"))
            return summed.select(
                F.lit(name).alias("wallet"),
                "asset_id",
                F.col("raw").cast("decimal(24,0)").alias("balance_raw"),
                F.lit(AS_OF).alias("observed_at"),
            )

        return (
            wallet(CONFIG.pool_wallet, "customer", _asset_code("c_custkey"), "c_acctbal")
            .unionByName(wallet(CONFIG.fee_wallet, "supplier", _asset_code("s_suppkey"), "s_acctbal"))
            .unionByName(wallet(CONFIG.treasury_wallet, "orders", F.lit(CONFIG.native_asset), "o_totalprice"))
        )

    def scalars(self) -> DataFrame:
        """Staked total and issuance, summed from ``lineitem``."""

        def total(column: str) -> Column:
            exact = F.sum(F.col(column).cast("decimal(18,2)")) * F.expr("cast(100000000 as decimal(9,0))")
            return exact.cast("decimal(24,0)")

        totals = self.table("lineitem").agg(total("l_quantity").alias("staked"), total("l_extendedprice").alias("issuance"))
        return totals.unpivot([], ["staked", "issuance"], "metric", "value_raw").withColumn("observed_at", F.lit(AS_OF))

    def transfer_pages(self) -> DataFrame:
        """One page per order; those of pending orders are failed calls."""
        key = F.col("o_orderkey")
        amount = (F.col("o_totalprice").cast("decimal(18,2)") * F.expr("0.000001")).cast(PRICE)
        transfer = F.struct(
            key.alias("transfer_id"),
            F.concat(F.lit("SYM"), (F.col("o_custkey") % 12).cast("string")).alias("asset_symbol"),
            amount.cast("string").alias("amount"),
            F.expr("o_orderkey div 10").alias("block_num"),
            (key % 10).alias("event_idx"),
        )
        return self.table("orders").select(
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("code"),
            F.struct(F.array(transfer).alias("transfers")).alias("data"),
        )

    def withdrawals(self) -> DataFrame:
        return chain.transfers(self.transfer_pages()).select("transfer_id", "asset_symbol", "amount")

    def metric_envelopes(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderpriority").alias("metric"),
            F.col("o_orderdate").cast("timestamp").alias("observed_at"),
            F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("code"),
            F.struct(F.col("o_custkey").alias("count")).alias("data"),
        )

    def role_payloads(self) -> DataFrame:
        nation, key = F.col("c_nationkey").cast("bigint"), F.col("c_custkey")

        def entry(role: Column, count: Column) -> Column:
            return F.struct(role.alias("role"), count.alias("count"))

        segment = F.col("c_mktsegment")
        building = F.when(segment == "BUILDING", "nominator").otherwise("pool")
        machinery = F.when(segment.isin("BUILDING", "MACHINERY"), "nominator").otherwise("council")
        entries = F.array(entry(F.lit("validator"), nation), entry(building, key), entry(machinery, nation + key))
        return self.table("customer").select(
            "c_custkey",
            F.lit(AS_OF).alias("observed_at"),
            F.when(F.col("c_acctbal") < 0, 10004).otherwise(0).alias("code"),
            F.when(segment != "HOUSEHOLD", entries).alias("data"),
        )

    # --- listings and order book ------------------------------------------------------------------

    def asset_pages(self) -> DataFrame:
        """One page of two assets per part."""
        key = F.col("p_partkey").cast("string")

        def item(symbol: Column, name: Column, asset_id: Column) -> Column:
            return F.struct(symbol.alias("symbol"), name.alias("name"), asset_id.alias("asset_id"))

        first = item(F.col("p_brand"), F.col("p_name"), key)
        second = item(F.col("p_type"), F.concat("p_name", F.lit(" alt")), F.concat(F.lit("X"), key))
        return self.table("part").select(F.col("p_partkey").alias("page"), F.array(first, second).alias("items"))

    def market_pages(self) -> DataFrame:
        """One page of one market per line item; some quote ids are no part."""
        market = F.concat_ws("-", F.col("l_partkey"), F.col("l_suppkey") * 25)
        return self.table("lineitem").select(F.array(F.struct(market.alias("market"))).alias("items"))

    @stored
    def book_pages(self) -> DataFrame:
        """Two snapshots of every market: line numbers up to 5, and from 3 on."""
        cents = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)")
        level = F.struct(
            (cents.cast("decimal(18,0)") * F.expr("0.01")).cast(PRICE).cast("string").alias("p"),
            F.col("l_quantity").cast("decimal(12,2)").cast(PRICE).cast("string").alias("q"),
            F.when(F.col("l_linestatus") == "O", "Ask").otherwise("Bid").alias("s"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("stid"),
        )
        number = F.col("l_linenumber")
        first, second = F.lit(1).cast("bigint"), F.lit(2).cast("bigint")
        taken = F.array_compact(F.array(F.when(number <= 5, first), F.when(number >= 3, second)))
        return self.table("lineitem").withColumn("snapshot_id", F.explode(taken)).select(
            F.concat(F.lit("S"), (F.col("l_suppkey") % 40).cast("string"), F.lit("-USDT")).alias("market"),
            "snapshot_id",
            number.alias("page"),
            F.array(level).alias("items"),
        )

    def book_pages_with_failures(self) -> DataFrame:
        """The same, where in the second snapshot a page of market S5 failed and one of S6 has a bad price."""
        second = F.col("snapshot_id") == 2
        item = F.get("items", F.lit(0))
        spoilt = F.array(item.withField("p", F.lit("n/a")))
        failed = second & (F.col("market") == "S5-USDT") & (F.col("page") == 4)
        bad = second & (F.col("market") == "S6-USDT") & (F.col("page") == 5)
        return self.book_pages().withColumn("items", F.when(bad, spoilt).when(~failed, F.col("items")))

    def snapshot(self, number: int) -> DataFrame:
        return self.book_pages().filter(F.col("snapshot_id") == number)

    def book(self) -> DataFrame:
        """The stored book after the first snapshot, in buckets.  Written once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, "book")
        if key not in _landed:
            store, levels = Store(self.spark, self.scratch("book")), cut_lineage(snapshot_levels(self.snapshot(1)))
            store.replace_buckets("orderbook", levels, store.buckets_of("orderbook", levels))
            _landed[key] = store.root
        return Store(self.spark, _landed[key]).read_buckets("orderbook")

    # --- history ----------------------------------------------------------------------------------

    def _asset_history(self, period: Column, name: str) -> DataFrame:
        """Per period and base asset: last price, running fees (a thousandth of the quantity), trades."""
        at = F.when(F.col("usd_price").isNotNull(), F.struct("timestamp", "trade_id"))
        grouped = self.priced().groupBy(period.alias(name), F.col("base_asset_id").alias("asset_id")).agg(
            F.sum("quantity").alias("sold"),
            F.max_by("usd_price", at).cast(PRICE).alias("price"),
            F.sum("volume").cast(VOLUME).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        running = Window.partitionBy("asset_id").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
        pool = self.balances().filter(F.col("wallet") == CONFIG.pool_wallet).select("asset_id", "balance_raw")
        history = grouped.join(pool, "asset_id", "left").withColumns(
            {
                "fees": (F.sum("sold").over(running) * F.expr("0.001")).cast(FEES),
                "new_fees": (F.col("sold") * F.expr("0.001")).cast(FEES),
                "balance": floor_amount(F.col("balance_raw"), 6),
            }
        )
        return history.withColumns(
            {
                "tvl": (F.col("balance") * F.col("price")).cast(USD),
                "fees_value": (F.col("fees") * F.col("price")).cast(USD),
                "new_fees_value": (F.col("new_fees") * F.col("price")).cast(USD),
                "balance": F.col("balance").cast(BALANCE),
            }
        )

    @stored
    def assets_daily(self) -> DataFrame:
        return conform(self._asset_history(F.to_date("timestamp"), "stat_date"), "assets_daily")

    @stored
    def assets_hourly(self) -> DataFrame:
        """Stamped with the end of the hour they sum up."""
        hour = F.date_trunc("hour", "timestamp") + F.expr("INTERVAL 1 HOUR")
        return conform(self._asset_history(hour, "stat_time"), "assets_hourly")

    def _exchange_history(self, period: Column, name: str) -> DataFrame:
        """Per period: users seen so far, sums over assets and trades."""
        priced = self.priced()
        measures = priced.groupBy(period.alias(name)).agg(
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("trades"),
            F.sum("quantity").cast("bigint").alias("total_staked"),
            F.sum("volume_quote").cast(USD).alias("staked_tvl"),
            F.count(F.when(F.col("quote_asset_id") != "USDT", 1)).alias("total_stakers"),
            F.max("quantity").cast("bigint").alias("treasury_balance"),
            F.max("price").cast(USD).alias("treasury_tvl"),
            F.count_distinct("base_asset_id").alias("total_holders"),
        )
        first_seen = priced.groupBy("user_id").agg(F.min(period).alias(name))
        new_users = first_seen.groupBy(name).agg(F.count(F.lit(1)).alias("new_users"))
        assets = self.assets_daily() if name == "stat_date" else self.assets_hourly()
        locked = assets.groupBy(name).agg(
            F.sum("tvl").alias("tvl"), F.sum("fees_value").alias("total_fees"), F.sum("new_fees_value").alias("new_total_fees")
        )
        running = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
        rows = measures.join(new_users, name, "left").join(locked, name, "left")
        return rows.withColumns(
            {"users": F.sum("new_users").over(running), "total_issuance": F.sum("trades").over(running)}
        )

    @stored
    def exchange_daily(self) -> DataFrame:
        """Day rows; the newest day is still open, without volume and trades."""
        rows = self._exchange_history(F.to_date("timestamp"), "stat_date")
        closed = F.col("stat_date") < F.lit(TODAY)
        rows = rows.withColumns({name: F.when(closed, F.col(name)) for name in ("volume", "trades")})
        return conform(rows, "exchange_daily")

    @stored
    def exchange_hourly(self) -> DataFrame:
        hour = F.date_trunc("hour", "timestamp") + F.expr("INTERVAL 1 HOUR")
        return conform(self._exchange_history(hour, "stat_time"), "exchange_hourly")


def _asset_code(column: str) -> Column:
    return F.concat(F.lit("A"), F.lpad((F.col(column) % 12).cast("string"), 2, "0"))
