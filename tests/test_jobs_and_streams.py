import json
from datetime import date, datetime, timedelta
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeglass import schemas
from tradeglass.operators import pricing
from tradeglass.plans.jobs import Jobs, Landed, Report
from tradeglass.plans.store import Store
from tradeglass.session import cut_lineage, scratch_dir
from tradeglass.sources.trades import stream_events
from tradeglass.streaming import windows
from tradeglass.streaming.trades import TradeStream

AS_OF = datetime(2024, 1, 30, 12, 3)
TODAY, YESTERDAY = date(2024, 1, 30), date(2024, 1, 29)


@pytest.fixture
def jobs(spark, config, tmp_path):
    return Jobs(Store(spark, str(tmp_path / "tables")), config)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def landed(spark):
    def page(kind, *values):
        return spark.createDataFrame(list(values), kind)

    return Landed(
        asset_pages=page(schemas.ASSET_LISTING, ([("U", "Dollar", "USD"), ("N", "Native", "NAT"), ("A", "Alpha", "AAA"), ("B", "Bad", "BAD")],)),
        market_pages=page(schemas.MARKET_LISTING, ([("NAT-USD",), ("AAA-NAT",), ("AAA-BAD",)],)),
        balances=page(
            schemas.WALLET_BALANCE,
            ("pool", "NAT", D(4 * 10**12), AS_OF), ("fees", "NAT", D(10**12), AS_OF), ("treasury", "NAT", D(7 * 10**12), AS_OF),
        ),
        metrics=page(schemas.METRIC_ENVELOPE, ("users", AS_OF, 0, (20,)), ("holders", AS_OF, 0, (30,))),
        roles=page(schemas.ROLE_COUNTS, (AS_OF, 0, [("nominator", 6)]), (AS_OF - timedelta(hours=1), 0, [("nominator", 9)])),
        scalars=page(schemas.CHAIN_SCALAR, ("staked", AS_OF, D(9 * 10**12)), ("issuance", AS_OF, D(11 * 10**12))),
        transfer_pages=page(schemas.TRANSFER_PAGE, (0, ([(1, "N", "0.5", 3, 1), (2, "N", "0.25", 3, 2)],))),
    )


def ingest(jobs, trades):
    moment = AS_OF - timedelta(hours=2)
    frame = trades(
        [
            (1, "NAT", "USD", 2, 1, 2, None, moment - timedelta(days=1)),
            (2, "AAA", "NAT", 3, 1, 3, None, moment - timedelta(days=1)),
            (3, "NAT", "USD", 4, 1, 4, None, moment),
            (4, "AAA", "NAT", 5, 2, 10, None, moment),
        ]
    )
    frame = frame.select(*frame.columns, *[F.lit(None).cast("string").alias(c.split()[0]) for c in schemas.TRADE_IDS.split(", ")])
    return jobs.ingest(pricing.price_trades(frame, jobs.config))


def test_all_jobs(spark, jobs, trades):
    store, inputs = jobs.store, landed(spark)
    first = jobs.refresh(AS_OF - timedelta(days=1), inputs)
    assert first.ok, first.steps
    assert ingest(jobs, trades) == [YESTERDAY, TODAY]
    assert rows(store.read("assets").select("asset_id", "price")) == [("AAA", D(20)), ("NAT", D(4)), ("USD", D(1))]
    assert store.read("assets").filter("asset_id = 'NAT'").first().tvl == 16  # moved with the price
    for as_of in (AS_OF - timedelta(days=1, hours=1), AS_OF):
        report = jobs.hourly(as_of, inputs)
        assert report.ok, report.steps
    report = jobs.refresh(AS_OF, inputs)
    assert report.ok, report.steps
    assert rows(store.read("fee_withdrawals").select("transfer_id", "amount")) == [(1, D("0.5")), (2, D("0.25"))]
    assert {r.data_name: r.data_value for r in store.read("metadata").collect()}["fees.after_id:event_idx"] == "2"
    nat = store.read("assets").filter("asset_id = 'NAT'").first()
    assert (nat.tvl, nat.fees, nat.fees_value) == (D(16), D("1.75"), D("7.00"))
    today = store.read("exchange_daily").filter(F.col("stat_date") == F.lit(TODAY)).first()
    assert (today.users, today.new_users, today.total_holders, today.total_stakers) == (20, 0, 30, 6)
    assert (today.total_staked, today.treasury_balance, today.treasury_tvl, today.total_issuance) == (9, 7, D(28), 11)
    markets = {r.base_asset_id: r for r in store.read("markets_24h").collect()}
    assert (markets["AAA"].trades, markets["AAA"].volume, markets["AAA"].previous_volume) == (1, D(40), D(6))
    exchange = store.read("exchange_24h").first()
    assert (exchange.trades, exchange.volume, exchange.previous_trades) == (2, D(44), 2)
    assert store.read("assets_daily").filter(F.col("stat_date") == F.lit(TODAY)).count() == 3

    tables = ["markets_24h", "assets_24h", "exchange_24h", "assets_daily", "markets_daily", "exchange_daily", "assets", "markets", "trades"]
    before = {name: rows(store.read(name)) for name in tables}
    assert jobs.refresh(AS_OF, inputs).ok
    assert {name: rows(store.read(name)) for name in tables} == before

    night = datetime(2024, 1, 31, 0, 5)
    for _ in range(2):
        report = jobs.nightly(night)
        assert report.ok, report.steps
        closed = store.read("exchange_daily").filter(F.col("stat_date") == F.lit(TODAY)).first()
        assert (closed.volume, closed.trades) == (D(44), 2)
        # Both days count: yesterday's trades came after its last refresh, so it was taken anew.
        assert store.read("exchange_alltime").first()[:2] == (D(52), 4)
        assert store.read("trades").count() == 4
    assert rows(store.read("market_closes").select("base_asset_id", "close_id", "trade_date")) == [
        ("AAA", 2, YESTERDAY), ("AAA", 4, TODAY), ("NAT", 1, YESTERDAY), ("NAT", 3, TODAY)
    ]


def test_retention(spark, jobs, trades):
    ingest(jobs, trades)
    store = jobs.store
    midnight = trades([(9, "NAT", "USD", 2, 1, 2, 2, datetime(2024, 1, 30)), (10, "NAT", "USD", 2, 1, 2, 2, datetime(2024, 1, 30, 0, 0, 1))])
    midnight = midnight.select(*midnight.columns, *[F.lit(None).cast("string").alias(c.split()[0]) for c in schemas.TRADE_IDS.split(", ")])
    store.merge_trades(midnight)
    store.clean_trades(TODAY + timedelta(days=60), 60)
    assert sorted(r.trade_id for r in store.read("trades").collect()) == [3, 4, 10]
    hours = spark.createDataFrame([(AS_OF - timedelta(days=7), "A"), (AS_OF, "A")], "stat_time timestamp, asset_id string")
    absent = [f.name for f in schemas.schema_of("assets_hourly") if f.name not in hours.columns]
    store.overwrite_partitions("assets_hourly", schemas.conform(hours.withColumns({n: F.lit(None) for n in absent}), "assets_hourly"))
    store.clean_hourly(AS_OF, 7)
    assert store.read("assets_hourly").count() == 1


def test_merge_of_trades(spark, jobs, trades):
    ingest(jobs, trades)
    store = jobs.store
    files = {r[0] for r in store.read("trades").select(F.input_file_name()).collect()}
    again = store.read("trades").withColumn("volume", F.lit(None).cast(schemas.VOLUME)).drop("trade_date")
    merged = store.merge_trades(again)  # the same events once more: nothing is written
    assert merged.rewritten == [] and {r[0] for r in store.read("trades").select(F.input_file_name()).collect()} == files
    assert store.read("trades").filter("volume is null").isEmpty()
    later = store.read("trades").filter("trade_id in (1, 2)").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    later = cut_lineage(later.drop("trade_date").withColumn("usd_price", F.lit(1.0)))
    assert jobs.ingest(later) == [YESTERDAY, TODAY]
    assert rows(store.read("trades").select("trade_id", "trade_date")) == [(i, TODAY) for i in (1, 2, 3, 4)]
    assert store.read("market_panes").agg(F.sum("trades"), F.min("trade_date")).first()[:] == (4, TODAY)
    assert rows(store.read("market_closes").select("trade_date", "close_id")) == [(TODAY, 3), (TODAY, 4)]
    assert store.merge_trades(later.limit(0)) is None


def test_backfill_equals_ingest(spark, jobs, trades, config, tmp_path):
    ingest(jobs, trades)
    other = Jobs(Store(spark, str(tmp_path / "other")), config)
    history = jobs.store.read("trades").drop("trade_date")
    other.backfill(history.unionByName(history))
    for name in ("trades", "trade_days", "market_panes", "market_closes", "asset_closes", "markets"):
        assert rows(other.store.read(name)) == rows(jobs.store.read(name)), name


def test_failed_step_does_not_stop(spark, jobs):
    report = Report(spark)
    report.run("bad", lambda: 1 / 0)
    report.run("none", lambda: False)
    report.run("good", lambda: None)
    assert report.steps["bad"].startswith("ZeroDivisionError") and not report.ok
    assert (report.steps["none"], report.steps["good"]) == ("skipped", "ok")


def test_unfinished_version_is_ignored(spark, jobs, tmp_path):
    store = jobs.store
    store.replace("metadata", spark.createDataFrame([("a", "1")], "data_name string, data_value string"))
    (tmp_path / "tables" / "metadata" / "v=1").mkdir()
    assert rows(store.read("metadata")) == [("a", "1")]
    for value in "2345":
        store.replace("metadata", spark.createDataFrame([("a", value)], "data_name string, data_value string"))
    assert rows(store.read("metadata")) == [("a", "5")]


def event(trade_id, market, price, moment, vq=None):
    millis = int((moment - datetime(1970, 1, 1)).total_seconds() * 1000)
    return json.dumps({"type": "TradeEvent", "m": market, "p": str(price), "q": "1", "vq": str(vq or price), "t": millis, "stid": trade_id})


def test_trade_stream_equals_batch(spark, jobs, tmp_path, trades):
    jobs.refresh(AS_OF, landed(spark))
    start = datetime(2024, 1, 30, 1)
    batches = [
        [event(1, "AAA-NAT", 2, start), event(2, "NAT-USD", 3, start + timedelta(minutes=1)), "broken"],
        [event(3, "AAA-NAT", 2, start + timedelta(minutes=2)), event(2, "NAT-USD", 3, start + timedelta(minutes=1))],
        [event(4, "NAT-USD", 5, start + timedelta(minutes=3)), event(5, "AAA-NAT", 2, start + timedelta(minutes=4)), event(6, "AAA-BAD", 2, start)],
    ]
    source, stream = tmp_path / "events", TradeStream(jobs)
    source.mkdir()
    for number, texts in enumerate(batches):
        (source / f"part-{number}.txt").write_text("\n".join(texts))
        stream.start(stream_events(spark, str(source)), str(tmp_path / "checkpoint")).awaitTermination()
    expected = [(1, None), (2, D(3)), (3, D(6)), (4, D(5)), (5, D(10))]
    assert rows(jobs.store.read("trades").select("trade_id", "volume")) == expected
    assert rows(spark.read.parquet(stream.quarantine).select("value")) == [("broken",)]
    state = rows(jobs.store.read(stream.prices, schema_like="asset_prices").select("asset_id", "usd_price"))
    assert state == [("AAA", 10.0), ("NAT", 5.0), ("USD", 1.0)]
    # The last batch again: nothing changes.
    again = spark.createDataFrame([(t,) for t in batches[2]], "value string")
    stream.process(again, 2)
    assert rows(jobs.store.read("trades").select("trade_id", "volume")) == expected
    # A late dollar trade before everything else: pricing the day again uses it.
    late = spark.createDataFrame([(event(7, "NAT-USD", 1, start - timedelta(minutes=1)),)], "value string")
    stream.process(late, 3)
    jobs.reprice_from(date(2024, 1, 30))
    assert rows(jobs.store.read("trades").select("trade_id", "volume"))[0] == (1, D(2))


def test_stream_prices_from_repriced_state(spark, jobs, tmp_path):
    jobs.refresh(AS_OF, landed(spark))
    start, stream = datetime(2024, 1, 30, 1), TradeStream(jobs)
    texts = [
        [event(1, "NAT-USD", 3, start), event(2, "AAA-NAT", 2, start + timedelta(minutes=5))],
        [event(3, "NAT-USD", 10, start + timedelta(minutes=1))],
        [event(4, "NAT-AAA", 2, start + timedelta(minutes=9))],
    ]
    frames = [spark.createDataFrame([(t,) for t in batch], "value string") for batch in texts]
    stream.process(frames[0], 0)
    stream.process(frames[1], 1)
    jobs.reprice_from(date(2024, 1, 30))
    jobs.store.replace("markets", spark.createDataFrame([("NAT", "USD", True, None), ("AAA", "NAT", True, None), ("NAT", "AAA", True, None)], schemas.schema_of("markets")))
    stream.process(frames[2], 2)
    assert rows(jobs.store.read("trades").select("trade_id", "volume")) == [(1, D(3)), (2, D(20)), (3, D(10)), (4, D(40))]


def test_intermediate_tables_are_deleted(spark, jobs):
    jobs.refresh(AS_OF, landed(spark))
    folder = Path(scratch_dir(spark)) / "intermediate"
    before = len(list(folder.glob("*"))) if folder.exists() else 0
    stream = TradeStream(jobs)
    for number in range(3):
        moment = datetime(2024, 1, 30, 1, number)
        stream.process(spark.createDataFrame([(event(number, "NAT-USD", 3 + number, moment),)], "value string"), number)
    assert len(list(folder.glob("*"))) == before


def test_a_held_version_stays_readable(spark, tmp_path):
    store = Store(spark, str(tmp_path / "held"))
    frame = spark.createDataFrame([("k", "v0")], schemas.schema_of("metadata"))
    store.replace("metadata", frame)
    held = store.read("metadata")
    for number in range(10):
        store.replace("metadata", frame.withColumn("data_value", F.lit(f"v{number}")))
    assert held.first().data_value == "v0"
    store.version_age = timedelta(seconds=-5)
    store.replace("metadata", frame)
    assert len(store._versions("metadata")) == 2


def test_a_driver_lost_in_an_exchange_loses_no_trade(spark, jobs, trades, monkeypatch):
    ingest(jobs, trades)
    store, before = jobs.store, rows(jobs.store.read("trades"))
    day = AS_OF.date()

    def lost(table, name):
        store.drop_partitions("trades", lambda found: found == day)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(store, "_end_exchange", lost)
    with pytest.raises(RuntimeError):
        store.compact_trades(day)
    monkeypatch.undo()
    assert rows(store.read("trades")) != before
    Jobs(store, jobs.config)
    assert rows(store.read("trades")) == before and not store._children("_pending", "trades")
    # Rows that were not written aside completely: the old day still stands.
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{store.root}/_pending/trades/half")
    store._files().delete(store._path("_pending", "trades", "half", "_SUCCESS"), False)
    store.recover("trades")
    assert rows(store.read("trades")) == before


def test_every_landed_transfer_is_stored(spark, jobs):
    jobs.refresh(AS_OF, landed(spark))
    page = (0, ([(i, "N", "0.5", 3 + i // 9, i % 9) for i in range(250)],))
    assert jobs.hourly(AS_OF, Landed(transfer_pages=spark.createDataFrame([page], schemas.TRANSFER_PAGE))).ok
    assert jobs.store.read("fee_withdrawals").count() == 250


def test_windows(spark, trades, tmp_path):
    start = datetime(2024, 1, 1)
    frame = trades([(i, "A", "U", 1, 1, 1, 1, start + timedelta(minutes=7 * i)) for i in range(600)])
    frame.unionByName(frame.filter("trade_id < 50")).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    sliding = windows.sliding(windows.once(source))
    windows.append_to(sliding, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    got = {r.window_end: r.trades for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    moments = [start + timedelta(minutes=7 * i) for i in range(600)]
    for end in (start + timedelta(minutes=5), start + timedelta(hours=24), start + timedelta(hours=50, minutes=35)):
        assert got[end] == sum(end - timedelta(hours=24) <= m < end for m in moments)
    days = windows.tumbling(windows.once(source), "1 day")
    windows.append_to(days, str(tmp_path / "days"), str(tmp_path / "c2")).awaitTermination()
    assert {r.window_start.day: r.trades for r in spark.read.parquet(str(tmp_path / "days")).collect()}[1] == 206


def test_transfer_and_book_streams(spark, jobs, tmp_path):
    inputs = landed(spark)
    inputs.transfer_pages.write.parquet(str(tmp_path / "pages"))
    pages = spark.readStream.schema(inputs.transfer_pages.schema).parquet(str(tmp_path / "pages"))
    for name in ("a", "b"):
        windows.store_transfers(pages, jobs, str(tmp_path / name)).awaitTermination()
    assert jobs.store.read("fee_withdrawals").count() == 2
    book = spark.createDataFrame([("A-U", 1, 1, [("1", "5", "Ask", "s")]), ("A-U", 2, 1, [("2", "5", "Ask", "s")])], schemas.ORDERBOOK_PAGE)
    book.write.parquet(str(tmp_path / "book"))
    stream = spark.readStream.schema(book.schema).parquet(str(tmp_path / "book"))
    windows.follow_book(stream, jobs, str(tmp_path / "c"), lambda: AS_OF).awaitTermination()
    assert [r.price for r in jobs.store.read("orderbook").collect()] == [D(2)]
    assert jobs.store.read("orderbook_lastupdate").first().last_update == AS_OF
