import json
from datetime import datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from tradeglass import schemas
from tradeglass.operators.admission import admitted_trades, unknown_assets
from tradeglass.sources import chain, listings, orderbook
from tradeglass.sources.trades import decode_events, parse_events, read_events, rejected_events

EVENT = {
    "type": "TradeEvent", "m": "NAT-USD", "p": "0.903", "q": "1", "vq": "0.903", "t": 1711027668215, "stid": 25383804,
    "trade_id": "0xed", "m_id": "0xcd", "t_id": "0x58", "m_cid": "c1", "t_cid": "c2", "m_side": "Ask", "t_side": "Bid",
}


def test_trade_events(spark, tmp_path):
    texts = [json.dumps(EVENT), "not json", json.dumps({**EVENT, "stid": None}), json.dumps({**EVENT, "p": "x", "stid": 2}),
             json.dumps({**EVENT, "m": "", "stid": 3})]
    (tmp_path / "events.txt").write_text("\n".join(texts))
    events = read_events(spark, str(tmp_path))
    row, = parse_events(events).collect()
    assert (row.trade_id, row.base_asset_id, row.quote_asset_id) == (25383804, "NAT", "USD")
    assert (row.price, row.quantity, row.volume_quote) == (D("0.9030000000"), D("1.0000000000"), D("0.9030000000"))
    assert row.timestamp == datetime(2024, 3, 21, 13, 27, 48)
    assert (row.trade_oid, row.m_id, row.t_side) == ("0xed", "0xcd", "Bid")
    assert sorted(r[0] for r in rejected_events(decode_events(events)).collect()) == sorted(texts[1:])


def test_listings(spark, config):
    pages = spark.createDataFrame(
        [([("U", "Dollar", "USD"), ("N", "Native", "NAT"), ("X", "Blocked", "BAD")],), ([("N2", "Native again", "NAT")],), ([],)],
        schemas.ASSET_LISTING,
    )
    numbered = pages.withColumn("page", F.monotonically_increasing_id())
    listed = {r.asset_id: r for r in listings.asset_listing(numbered, config).collect()}
    assert set(listed) == {"USD", "NAT"}
    assert listed["USD"].price == D("1.0000000000") and listed["NAT"].price is None
    assert listed["NAT"].symbol == "N2"
    markets = spark.createDataFrame(
        [([("NAT-USD",), ("NAT-BAD",), ("NAT-ZZZ",)],), ([("NAT-USD",), ("NAT",)],)], schemas.MARKET_LISTING
    )
    got = listings.market_listing(markets, listings.asset_listing(numbered, config), config).collect()
    assert [tuple(r) for r in got] == [("NAT-USD", "NAT", "USD")]


def test_admission(spark, config, trades):
    now = datetime(2024, 1, 1)
    rows = trades([(1, "NAT", "USD", 1, 1, 1, None, now), (2, "NAT", "BAD", 1, 1, 1, None, now), (3, "NAT", "EUR", 1, 1, 1, None, now)])
    markets = spark.createDataFrame([("NAT", "USD"), ("NAT", "BAD")], "base_asset_id string, quote_asset_id string")
    assert [r.trade_id for r in admitted_trades(rows, markets, config).collect()] == [1]
    assert admitted_trades(rows, markets.limit(0), config).isEmpty()
    assets = spark.createDataFrame([("NAT",), ("USD",)], "asset_id string")
    orphans = {(r.column_name, r.asset_id, r.row_count) for r in unknown_assets(rows, assets, "trades").collect()}
    assert orphans == {("quote_asset_id", "BAD", 1), ("quote_asset_id", "EUR", 1)}


def test_snapshot_levels(spark):
    pages = spark.createDataFrame(
        [
            ("A-U", 1, 1, [("1.0", "5", "Ask", "s1"), ("2", "5", "Bid", "s2")]),
            ("A-U", 1, 7, [("1.00", "6", "Ask", "s3")]),
            ("B-U", 1, 1, []),
            ("C-U", 1, 1, None),
        ],
        schemas.ORDERBOOK_PAGE,
    )
    levels = {(r.price, r.side): (r.quantity, r.stid) for r in orderbook.snapshot_levels(pages).collect()}
    assert levels == {(D("1.0000000000"), "Ask"): (D("6.0000000000"), "s3"), (D("2.0000000000"), "Bid"): (D("5.0000000000"), "s2")}
    covered = {r.base_asset_id for r in orderbook.snapshot_markets(pages).collect()}
    assert covered == {"A", "B"}


def test_incomplete_snapshots(spark):
    good = [("1", "5", "Ask", "s")]
    pages = spark.createDataFrame(
        [
            ("A-U", 1, 1, good), ("A-U", 2, 1, good), ("A-U", 2, 2, None),
            ("B-U", 1, 1, None), ("B-U", 1, 2, good),
            ("C-U", 1, 1, good), ("C-U", 2, 1, [("x", "5", "Ask", "s")]),
            ("D-U", 1, 1, [("1", "5", "Ask", "s"), ("1", None, "Bid", "t")]),
            ("E-U", 1, 1, good), ("E-U", 2, 1, []),
        ],
        schemas.ORDERBOOK_PAGE,
    )
    taken = {(r.market, r.snapshot_id) for r in orderbook.latest_snapshot(pages).collect()}
    assert taken == {("A-U", 1), ("C-U", 1), ("E-U", 2)}
    rejected = {(r.market, r.snapshot_id, r.page) for r in orderbook.rejected_pages(pages).collect()}
    assert rejected == {("A-U", 2, 2), ("B-U", 1, 1), ("C-U", 2, 1), ("D-U", 1, 1)}


def test_balances_and_metrics(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    balances = spark.createDataFrame(
        [("w", "A", D(1), early), ("w", "A", D(2), late), ("x", "B", D(3), late)], schemas.WALLET_BALANCE
    )
    assets = spark.createDataFrame([("A",), ("B",)], "asset_id string")
    got = {r.asset_id: r.balance_raw for r in chain.wallet_balances(balances, assets, "w").collect()}
    assert got == {"A": D(2), "B": None}
    envelopes = spark.createDataFrame(
        [("users", early, 0, (5,)), ("users", late, 1, (9,)), ("holders", late, 0, (7,))], schemas.METRIC_ENVELOPE
    )
    assert {r.metric: r.value for r in chain.latest_metrics(envelopes).collect()} == {"users": 5, "holders": 7}
    roles = spark.createDataFrame(
        [(None, 0, [("validator", 1), ("nominator", 2), ("nominator", 3)]), (None, 0, [("validator", 1)]), (None, 0, None), (None, 5, [("nominator", 2)])],
        schemas.ROLE_COUNTS,
    )
    assert [r.stakers for r in chain.role_count(roles).collect()] == [2, None, None, None]


def test_transfers(spark):
    pages = spark.createDataFrame(
        [
            (0, ([(1, "N", "1.5", 10, 3), (2, "N", "2", 10, 4), (3, "N", "bad", 11, 0)],)),
            (1, ([(4, "N", "1", 12, 0)],)),
        ],
        schemas.TRANSFER_PAGE,
    )
    rows = chain.transfers(pages)
    assert {r.transfer_id: r.amount for r in rows.collect()} == {1: D("1.5000000000"), 2: D("2.0000000000"), 3: None}
    assert sorted(r.transfer_id for r in chain.transfers_after(rows, 10, 3).collect()) == [2, 3]
    assert [r.transfer_id for r in chain.transfers_after(rows, 0, 0, 2).collect()] == [1, 2]
    cursor = chain.cursor_rows(rows)
    assert chain.cursor_value(cursor) == (11, 0)
    assert chain.cursor_rows(rows.limit(0)).isEmpty()
    assert chain.cursor_value(cursor.limit(0)) == (0, 0)
