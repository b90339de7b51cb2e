from datetime import date, datetime
from decimal import Decimal as D

from tradeglass import schemas
from tradeglass.operators import book, upsert, values
from tradeglass.sources import orderbook

TODAY = date(2024, 1, 30)


def raw(spark, **amounts):
    return spark.createDataFrame([(k, v) for k, v in amounts.items()], "asset_id string, balance_raw decimal(24,0)")


def test_tvl(spark, table):
    assets = table("assets", [{"asset_id": "A", "price": D("2.5")}, {"asset_id": "B", "price": None}, {"asset_id": "C", "price": D(1)}])
    balances = raw(spark, A=D(3 * 10**12), B=D(10**12), C=None)
    got = {r.asset_id: (r.balance, r.tvl) for r in values.asset_tvl(assets, balances).collect()}
    assert got == {"A": (D("3.0000"), D("7.50")), "B": (D("1.0000"), None), "C": (None, None)}


def test_fees(spark, table):
    assets = table(
        "assets",
        [{"asset_id": a, "symbol": s, "price": p} for a, s, p in
         [("A", "S", D(2)), ("B", "S", D(1)), ("C", "T", None), ("D", "U", D(1)), ("E", "V", D(1))]],
    )
    held = raw(spark, A=D("5000000900000"), B=D(10**12), C=D(10**12), D=None, E=D(10**12))
    withdrawals = table("fee_withdrawals", [{"transfer_id": 1, "asset_symbol": "S", "amount": D("0.5")}, {"transfer_id": 2, "asset_symbol": "S", "amount": D(1)}, {"transfer_id": 3, "asset_symbol": "X", "amount": D(1)}])
    fanned = {r.asset_id: r.amount for r in values.fee_withdrawals_by_asset(withdrawals, assets).collect()}
    assert fanned == {"A": D("1.5"), "B": D("1.5")}
    history = table(
        "assets_daily",
        [
            {"stat_date": date(2024, 1, 28), "asset_id": "A", "fees": D(1)},
            {"stat_date": date(2024, 1, 29), "asset_id": "A", "fees": D(6)},
            {"stat_date": TODAY, "asset_id": "A", "fees": D(100)},
            {"stat_date": date(2024, 1, 29), "asset_id": "B", "fees": D(4)},
            {"stat_date": date(2024, 1, 29), "asset_id": "C", "fees": None},
            {"stat_date": date(2024, 1, 29), "asset_id": "D", "fees": D(1)},
        ],
    )
    got = {r.asset_id: r for r in values.asset_fees(assets, held, withdrawals, history, TODAY).collect()}
    assert (got["A"].fees, got["A"].new_fees, got["A"].new_fees_value) == (D("6.5"), D("0.5"), D("1.00"))
    assert got["A"].fees_value == D("13.00")
    assert got["B"].new_fees == 0  # below the previous total
    assert (got["C"].fees, got["C"].fees_value, got["C"].new_fees) == (D(1), None, D(1))
    assert (got["D"].fees, got["D"].new_fees) == (None, None)
    assert (got["E"].fees, got["E"].new_fees) == (D(1), None)  # no previous day
    deltas = {(r.asset_id, r.stat_date.day): r.new_fees for r in values.fee_deltas(history).collect()}
    assert deltas[("A", 28)] is None and deltas[("A", 29)] == 5 and deltas[("A", 30)] == 94


def test_users(spark, table):
    days = table("exchange_daily", [{"stat_date": date(2024, 1, d), "users": u} for d, u in [(1, 5), (3, 9), (4, 7)]])
    assert [(r.users, r.new_users) for r in values.user_deltas(days).orderBy("stat_date").collect()] == [(5, None), (9, 4), (7, -2)]
    total = spark.createDataFrame([(12,)], "users bigint")
    previous = spark.createDataFrame([(7,)], "users bigint")
    assert values.user_metrics(total, previous).first().new_users == 5
    assert values.user_metrics(total, previous.limit(0)).first().new_users is None


def test_treasury(spark, table, config):
    scalars = spark.createDataFrame([("staked", D(123456 * 10**10)), ("issuance", D(99995 * 10**10))], "metric string, value_raw decimal(24,0)")
    treasury = raw(spark, NAT=D(2 * 10**12), A=D(10**12))
    assets = table("assets", [{"asset_id": "NAT", "price": D("1.5")}])
    row = values.treasury_metrics(scalars, treasury, assets, config).first()
    assert tuple(row) == (1235, D("1851.84"), 2, D("3.00"), 1000)
    row = values.treasury_metrics(scalars, treasury, assets.limit(0), config).first()
    assert tuple(row) == (None, None, None, None, 1000)


def book_row(market, price, side, stid, quantity):
    base, quote = market.split("-")
    return {"base_asset_id": base, "quote_asset_id": quote, "price": D(price), "side": side, "stid": stid, "quantity": D(quantity)}


def test_book(spark, table):
    stored = table(
        "orderbook",
        [
            book_row("A-U", "1.0", "Ask", "old1", 5), book_row("A-U", "2", "Ask", "old2", 5), book_row("A-U", "3", "Ask", "old3", 5),
            book_row("B-U", "1", "Bid", "old4", 5), book_row("C-U", "1", "Bid", "old5", 5),
        ],
    )
    pages = spark.createDataFrame(
        [
            ("A-U", 1, 1, [("1.00", "5", "Ask", "new1"), ("2", "6", "Ask", "new2"), ("4", "7", "Bid", "new3")]),
            ("A-U", 1, 2, [("4.0", "8", "Bid", "new4")]),
            ("B-U", 1, 1, []),
        ],
        schemas.ORDERBOOK_PAGE,
    )
    levels, markets = orderbook.snapshot_levels(pages), orderbook.snapshot_markets(pages)
    changes = {(r.base_asset_id, int(r.price)): (r.change, r.stid, r.quantity) for r in book.book_changes(stored, levels, markets).collect()}
    assert changes == {
        ("A", 1): ("same", "old1", D(5)), ("A", 2): ("update", "old2", D(6)), ("A", 3): ("delete", "old3", None),
        ("A", 4): ("insert", "new4", D(8)), ("B", 1): ("delete", "old4", None),
    }
    after = book.apply_snapshot(stored, levels, markets)
    assert {(r.base_asset_id, int(r.price), r.stid) for r in after.collect()} == {
        ("A", 1, "old1"), ("A", 2, "old2"), ("A", 4, "new4"), ("C", 1, "old5")
    }
    again = book.apply_snapshot(after, levels, markets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))
    assert len(orderbook.book_of(stored, "A", "U").collect()) == 3


def test_asset_and_market_rules(table):
    stored = table("assets", [{"asset_id": "A", "symbol": "a", "name": "x", "is_active": True, "price": D(1), "fees": D(2)}])
    source = table("assets", [{"asset_id": "A", "symbol": "b", "name": None, "is_active": True, "price": None, "fees": D(3)}, {"asset_id": "B", "price": D(9)}])
    got = {r.asset_id: r for r in upsert.upsert_assets(stored, source).collect()}
    assert (got["A"].symbol, got["A"].name, got["A"].price, got["A"].fees, got["B"].price) == ("b", None, D(1), D(3), D(9))
    markets = table("markets", [{"base_asset_id": "A", "quote_asset_id": "U", "is_active": True, "price": D(4)}])
    refresh = table("markets", [{"base_asset_id": "A", "quote_asset_id": "U", "is_active": True}])
    assert upsert.upsert_markets(markets, refresh).first().price == D(4)


def test_merge_rules(spark):
    target = spark.createDataFrame([(1, "o", "o", None)], "k int, a string, b string, c string")
    source = spark.createDataFrame([(1, None, "n", "n")], "k int, a string, b string, c string")
    rules = {"a": upsert.keep_new, "b": upsert.keep_old, "c": upsert.frozen}
    assert tuple(upsert.merge_rows(target, source, ["k"], rules).first()) == (1, "o", "o", None)
    assert tuple(upsert.merge_rows(target, source, ["k"], {}).first()) == (1, None, "n", "n")


def test_trades_replaced_by_id(trades):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    stored = trades([(1, "A", "U", 1, 1, 1, 5, early), (2, "A", "U", 1, 1, 1, 5, early)])
    source = trades([(1, "A", "U", 2, 1, 1, None, early), (1, "A", "U", 3, 1, 1, None, late), (3, "A", "U", 1, 1, 1, 1, early)])
    got = {r.trade_id: r for r in upsert.upsert_trades(stored, source).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].price, got[1].volume, got[1].timestamp) == (D(3), None, late)


def test_merge_of_trades_is_spread_by_rows(trades, monkeypatch):
    monkeypatch.setattr(upsert, "TASK_ROWS", 20)
    day = datetime(2024, 1, 1)
    stored = trades([(i, "A", "U", 1, 1, 1, 5, day) for i in range(0, 200, 2)])
    source = trades([(i, "A", "U", p, 1, 1, 6, day) for i in range(150) for p in (2, 3)])
    merged = upsert.upsert_trades(stored, source)
    assert merged.rdd.getNumPartitions() >= 300 // 20
    got = {r.trade_id: int(r.price) for r in merged.collect()}
    assert got == {i: 3 for i in range(150)} | {i: 1 for i in range(150, 200, 2)}


def test_insert_ignore(spark, table):
    stored = table("fee_withdrawals", [{"transfer_id": 1, "asset_symbol": "S", "amount": D(1)}])
    source = spark.createDataFrame(
        [(1, "S", "9", 1), (2, "S", "2", 5), (2, "S", "3", 4), (3, "", "1", 1), (4, "S", None, 1), (None, "S", "1", 1), (5, None, "1", 1)],
        "transfer_id bigint, asset_symbol string, amount string, block_num bigint",
    )
    source = source.withColumn("amount", source.amount.cast(schemas.PRICE))
    new = upsert.insert_new(stored, source, "transfer_id", ["transfer_id", "asset_symbol", "amount"], ["block_num"])
    assert [tuple(r) for r in new.collect()] == [(2, "S", D(3))]
