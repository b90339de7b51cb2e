from datetime import date, datetime, timedelta
from decimal import Decimal as D

from tradeglass.operators import daily, hourly, rolling
from tradeglass.operators.activity import panes
from tradeglass.schemas import EXCHANGE_MEASURES

AS_OF = datetime(2024, 1, 30, 12)
TODAY = AS_OF.date()


def ago(**kwargs):
    return AS_OF - timedelta(**kwargs)


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "base_asset_id string, quote_asset_id string")


def ids(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "asset_id string")


def window_trades(trades):
    return trades(
        [
            (1, "A", "U", 5, 1, 5, 5, ago(hours=24, seconds=1)),
            (2, "A", "U", 6, 1, 6, 6, ago(hours=24)),
            (3, "A", "U", 7, 2, 14, 14, ago(hours=23, minutes=59, seconds=59)),
            (4, "A", "U", 8, 1, 8, None, ago(hours=1)),
            (5, "A", "U", 9, 1, 9, 9, ago(hours=48)),
            (6, "A", "U", 10, 1, 10, 10, ago(hours=47)),
            (7, "A", "U", 99, 1, 99, 99, ago(seconds=-1)),
            (8, "U", "A", 1, 3, 3, 2, ago(hours=2)),
        ]
    )


def test_markets_24h(spark, trades):
    markets = pairs(spark, ("A", "U"), ("U", "A"), ("Z", "U"), ("A", "GONE"))
    rows = rolling.markets_24h(window_trades(trades), markets, ids(spark, "A", "U", "Z"), AS_OF).collect()
    got = {(r.base_asset_id, r.quote_asset_id): r for r in rows}
    assert set(got) == {("A", "U"), ("U", "A"), ("Z", "U")}
    busy, idle = got[("A", "U")], got[("Z", "U")]
    assert (busy.trades, busy.volume, busy.volume_base) == (2, D("14.000000"), D("3.0000000000"))
    assert (busy.previous_trades, busy.previous_volume) == (2, D("15.000000"))
    assert (busy.price_low, busy.price_high) == (D("7.0000000000"), D("8.0000000000"))
    assert busy.price_24h == D("10.0000000000")  # greatest id at or before the cut, not the latest one
    assert (idle.trades, idle.volume, idle.price_low, idle.price_24h) == (0, D("0.000000"), None, D("0E-10"))


def test_closes_stand_in_for_old_trades(spark, trades):
    rows, markets, assets = window_trades(trades), pairs(spark, ("A", "U"), ("U", "A")), ids(spark, "A", "U")
    closes = rolling.market_closes(rows)
    whole = rolling.markets_24h(rows, markets, assets, AS_OF)
    quick = rolling.markets_24h(rows, markets, assets, AS_OF, closes=closes)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, quick.collect()))


def test_assets_24h_sums_both_legs(spark, trades, table):
    assets = table("assets", [{"asset_id": "A", "price": D(2), "fees": D(1), "new_fees": D(3)}, {"asset_id": "U"}, {"asset_id": "Z"}])
    hours = table(
        "assets_hourly",
        [
            {"stat_time": ago(days=2), "asset_id": "A", "price": D(1), "fees": D(9)},
            {"stat_time": ago(days=1), "asset_id": "A", "price": D(5), "balance": D(7)},
            {"stat_time": ago(hours=2), "asset_id": "A", "price": D(6)},
        ],
    )
    got = {r.asset_id: r for r in rolling.assets_24h(window_trades(trades), assets, hours, AS_OF).collect()}
    a = got["A"]
    assert (a.trades, a.volume, a.previous_trades) == (3, D("16.000000"), 2)
    assert (a.price, a.fees, a.new_fees, a.previous_price, a.previous_fees) == (D(2), D(1), D(3), D(5), D(0))
    assert a.previous_balance == D(7) and a.balance is None
    assert (got["U"].trades, got["Z"].trades, got["Z"].price) == (3, 0, D(0))


def test_exchange_24h(spark, trades, table):
    days = table("exchange_daily", [{"stat_date": TODAY, "users": 50, "tvl": D(3)}, {"stat_date": date(2024, 1, 1), "users": 7}])
    hours = table(
        "exchange_hourly",
        [{"stat_time": ago(hours=25), "users": 40, "tvl": D(2)}, {"stat_time": ago(hours=60), "users": 25}, {"stat_time": ago(hours=1), "users": 49}],
    )
    rows = window_trades(trades)
    row = rolling.exchange_24h(rows, days, hours, AS_OF).first()
    assert (row.users, row.new_users, row.previous_users, row.previous_new_users) == (50, 10, 40, 15)
    assert (row.tvl, row.previous_tvl, row.total_fees) == (D(3), D(2), D(0))
    assert (row.trades, row.volume, row.previous_trades) == (3, D("16.000000"), 2)
    row = rolling.exchange_24h(rows, days, hours.limit(0), AS_OF).first()
    assert (row.new_users, row.previous_users, row.previous_new_users) == (50, 0, 0)
    assert rolling.exchange_24h(rows, days.limit(0), hours, AS_OF).isEmpty()
    quiet = rolling.exchange_24h(rows.limit(0), days, hours, AS_OF).first()
    assert (quiet.trades, quiet.volume, quiet.previous_volume) == (0, D(0), D(0))


def test_markets_daily(spark, trades):
    rows = trades([(1, "A", "U", 2, 3, 6, None, ago(hours=1)), (2, "B", "U", 1, 1, 1, 1, ago(days=3))])
    markets = pairs(spark, ("A", "U"), ("B", "U"), ("C", "U"))
    got = {r.base_asset_id: r for r in daily.markets_daily(rows, markets, TODAY).collect()}
    assert set(got) == {"A", "C"}  # B was traded on another day: no zero row
    assert (got["A"].volume, got["A"].volume_base, got["A"].trades) == (None, D(3), 1)
    assert (got["C"].volume, got["C"].trades, got["C"].stat_date) == (D(0), 0, TODAY)


def test_assets_daily_legs(spark, trades, table):
    rows = trades([(1, "A", "U", 1, 1, 1, 4, ago(hours=1)), (2, "B", "A", 1, 1, 1, 4, ago(hours=2)), (3, "Q", "U", 1, 1, 1, 1, ago(hours=2))])
    assets = table("assets", [{"asset_id": a, "tvl": D(10), "price": None} for a in "ABUZ"])
    got = {r.asset_id: r for r in daily.assets_daily(rows, assets, TODAY).collect()}
    assert set(got) == set("ABUZQ")
    assert (got["A"].volume, got["A"].trades, got["A"].tvl) == (D(8), 2, D(10))
    assert (got["U"].volume, got["U"].trades) == (D(5), 2)
    assert (got["Z"].volume, got["Z"].trades, got["Z"].price) == (D(0), 0, None)
    assert (got["Q"].trades, got["Q"].tvl) == (1, None)
    literal = {r.asset_id: r for r in daily.assets_daily(rows, assets, TODAY, compat=True).collect()}
    assert (literal["A"].volume, literal["A"].trades, literal["A"].tvl) == (D(4), 1, D(10))  # equal legs collapse
    more = trades([(1, "A", "U", 1, 1, 1, 4, ago(hours=1)), (2, "B", "A", 1, 1, 1, 5, ago(hours=2))])
    literal = {r.asset_id: r for r in daily.assets_daily(more, assets, TODAY, compat=True).collect()}
    assert (literal["A"].volume, literal["A"].trades, literal["A"].tvl) == (D(9), 2, D(20))
    assert {r.asset_id for r in daily.idle_assets(assets, rows, TODAY).collect()} == {"Z"}


def test_exchange_day_rows(spark, trades, table):
    days = table("exchange_daily", [{"stat_date": TODAY, "users": 5, "total_staked": 9}, {"stat_date": date(2024, 1, 29), "volume": D(7), "trades": 2, "total_fees": D(4)}])
    rows = trades([(1, "A", "U", 1, 1, 1, 4, ago(hours=1)), (2, "A", "U", 1, 1, 1, None, ago(hours=2))])
    closed = {r.stat_date: r for r in daily.exchange_daily_close(days, rows, TODAY).collect()}
    assert (closed[TODAY].volume, closed[TODAY].trades) == (D(4), 2)
    empty = {r.stat_date: r for r in daily.exchange_daily_close(days, rows, date(2024, 1, 29)).collect()}
    assert (empty[date(2024, 1, 29)].volume, empty[date(2024, 1, 29)].trades) == (None, 0)
    assets = table("assets", [{"asset_id": "A", "tvl": D(3)}, {"asset_id": "B", "tvl": D(4), "fees_value": D(1)}])
    metrics = spark.createDataFrame([(None, 3)], "users bigint, total_holders bigint")
    got = {r.stat_date: r for r in daily.exchange_daily_measures(days, assets, metrics, TODAY).collect()}[TODAY]
    assert (got.tvl, got.total_fees, got.users, got.total_holders, got.total_staked) == (D(7), D(1), 5, 3, 9)
    alltime = daily.exchange_alltime(days).first()
    assert (alltime.volume, alltime.trades, alltime.total_fees) == (D(7), 2, None)
    assert daily.previous_users(days, TODAY).first().stat_date == date(2024, 1, 29)


def test_roll_forward(table):
    old = {"stat_date": date(2024, 1, 28), **{m: 1 for m in ("users", "trades")}, "tvl": D(5), "total_fees": D(6), "volume": D(7)}
    days = table("exchange_daily", [old, {"stat_date": date(2024, 1, 27), "users": 9}])
    rows = {r.stat_date: r for r in daily.new_day_rollforward(days, TODAY).collect()}
    new = rows[TODAY]
    assert (new.users, new.tvl, new.total_fees, new.volume, new.trades) == (1, D(5), None, None, None)
    again = {r.stat_date: r for r in daily.new_day_rollforward(daily.new_day_rollforward(days, TODAY), TODAY).collect()}[TODAY]
    assert (again.total_fees, again.volume) == (D(6), None)
    present = table("exchange_daily", [old, {"stat_date": TODAY, "users": 3}])
    filled = {r.stat_date: r for r in daily.new_day_rollforward(present, TODAY).collect()}[TODAY]
    assert (filled.users, filled.tvl, filled.total_fees, filled.trades) == (3, D(5), D(6), None)
    assert daily.new_day_rollforward(days.limit(0), TODAY).isEmpty()
    assert set(days.columns) == {"stat_date", *EXCHANGE_MEASURES}


def test_hourly_and_retention(spark, trades, table):
    assets = table("assets", [{"asset_id": "A", "price": None, "tvl": D(1)}])
    row = hourly.assets_hourly(assets, datetime(2024, 1, 30, 12, 8, 7)).first()
    assert (row.stat_time, row.asset_id, row.price) == (AS_OF, "A", None)
    days = table("exchange_daily", [{"stat_date": TODAY, "users": 2}, {"stat_date": date(2024, 1, 1), "users": 1}])
    assert hourly.exchange_hourly(days, AS_OF).first().users == 2
    cut = datetime(2023, 12, 1)  # 60 days before
    rows = trades([(1, "A", "U", 1, 1, 1, 1, cut), (2, "A", "U", 1, 1, 1, 1, cut + timedelta(seconds=1)), (3, "A", "U", 1, 1, 1, 1, cut - timedelta(days=1))])
    assert [r.trade_id for r in hourly.retained_trades(rows, TODAY, 60).collect()] == [2]
    hours = table("assets_hourly", [{"stat_time": ago(days=7), "asset_id": "A"}, {"stat_time": ago(days=6, hours=23), "asset_id": "B"}])
    assert [r.asset_id for r in hourly.retained_hourly(hours, AS_OF).collect()] == ["B"]
    assert hourly.freshness_stamp(spark, AS_OF).first().last_update == AS_OF


def test_panes_equal_trades(spark, trades, table):
    rows, markets, assets = window_trades(trades), pairs(spark, ("A", "U"), ("U", "A"), ("Z", "U")), table("assets", [{"asset_id": a} for a in "AUZ"])
    summed = panes(rows)
    for as_of in (AS_OF, AS_OF - timedelta(hours=24), AS_OF + timedelta(minutes=1)):
        whole = sorted(map(tuple, rolling.market_windows(rows, as_of).collect()))
        assert sorted(map(tuple, rolling.market_windows(summed, as_of).collect())) == whole
    for day in (TODAY, TODAY - timedelta(days=1)):
        for op in (lambda r: daily.markets_daily(r, markets, day), lambda r: daily.assets_daily(r, assets, day)):
            assert sorted(map(str, op(summed).collect())) == sorted(map(str, op(rows).collect()))
