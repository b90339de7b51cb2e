"""Physical plans: what the scans skip and how often data is moved."""

import re
from datetime import datetime, timedelta

import pytest

from tradeglass.operators import daily, pricing, rolling
from tradeglass.plans.store import Store
from tradeglass.schemas import conform, schema_of
from tradeglass.workload.queries import QUERIES

AS_OF = datetime(2024, 1, 30, 12)


def plan(frame) -> str:
    return re.sub(r"#\d+L?", "", frame._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def stored(spark, trades, table, tmp_path):
    from pyspark.sql import functions as F

    rows = trades([(i, "A", "U" if i % 2 else "B", 1, 1, 1, 1, AS_OF - timedelta(hours=3 * i)) for i in range(40)])
    absent = {f.name: F.lit(None) for f in schema_of("trades") if f.name not in rows.columns}
    store = Store(spark, str(tmp_path))
    store.overwrite_partitions("trades", conform(rows.withColumns({**absent, "trade_date": F.to_date("timestamp")}), "trades", "trade_date"))
    return store


def test_rolling_reads_three_days_and_few_columns(stored, table, spark):
    windows = plan(rolling.market_windows(stored.read("trades"), AS_OF))
    assert "PartitionFilters: [isnotnull(trade_date), (trade_date >= 2024-01-28), (trade_date <= 2024-01-30)]" in windows
    assert "GreaterThan(timestamp,2024-01-28 12:00:00.0)" in windows and "m_id" not in windows
    assert windows.count("Exchange hashpartitioning") == 1


def test_no_nested_loops(stored, table, config, spark):
    trades = stored.read("trades")
    assets, markets = table("assets", [{"asset_id": "A"}]), table("markets", [{"base_asset_id": "A", "quote_asset_id": "U"}])
    hours, days = table("assets_hourly", []), table("exchange_daily", [])
    frames = [
        rolling.markets_24h(trades, markets, assets, AS_OF),
        rolling.assets_24h(trades, assets, hours, AS_OF),
        rolling.exchange_24h(trades, days, table("exchange_hourly", []), AS_OF),
        daily.assets_daily(trades, assets, AS_OF.date()),
        daily.markets_daily(trades, markets, AS_OF.date()),
        daily.idle_assets(assets, trades, AS_OF.date()),
        daily.new_day_rollforward(days, AS_OF.date()),
    ]
    for frame in frames:
        text = plan(frame)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_pricing_moves_trades_once(stored, config):
    text = plan(pricing.price_trades(stored.read("trades").drop("volume"), config))
    assert text.count("Window [") == 1 and text.count("Exchange hashpartitioning") == 1


def test_day_figures_read_one_day(stored):
    text = plan(daily.exchange_daily_close(stored.read("exchange_daily"), stored.read("trades"), AS_OF.date()))
    assert "(trade_date >= 2024-01-30), (trade_date <= 2024-01-30)" in text


@pytest.mark.parametrize(
    "name",
    ["markets_24h", "markets_24h_from_closes", "markets_24h_from_panes", "markets_daily", "markets_daily_from_panes",
     "idle_markets", "assets_24h", "exchange_24h", "assets_daily", "exchange_daily_close", "idle_assets"],
)
def test_rollups_read_no_old_trades(spark, name):
    """Every scan of trades is bounded by a day at most three days back."""
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for scan in re.findall(r"FileScan parquet .*", text):
        if re.search(r"/(trades|market_panes)\]", scan):
            first = re.search(r"trade_date >= (\d{4}-\d\d-\d\d)", scan)
            assert first and first[1] >= "2024-01-27", scan
