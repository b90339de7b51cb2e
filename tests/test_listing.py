"""Listings over time: what a replay admits is what a run admitted."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradeglass import schemas
from tradeglass.operators import listing
from tradeglass.operators.admission import admitted_trades
from tradeglass.plans.jobs import Jobs, Landed
from tradeglass.plans.store import Store
from tradeglass.streaming.trades import TradeStream

from test_jobs_and_streams import event, rows
from test_plans import plan

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
MARKETS = [(f"B{i}", "U") for i in range(5)]


def pairs(spark, *names):
    return spark.createDataFrame(list(names), "base_asset_id string, quote_asset_id string")


def drawn(seed, n=12):
    """Listings an hour apart; one of them names no market."""
    random.seed(seed)
    return [(START + k * HOUR, [] if k == 5 else [m for m in MARKETS if random.random() < 0.6]) for k in range(n)]


def whole(spark, taken):
    listed = [(b, q, t) for t, names in taken for b, q in names]
    moments = spark.createDataFrame([(t,) for t, _ in taken], "taken_at timestamp")
    return listing.listing_history(spark.createDataFrame(listed, "base_asset_id string, quote_asset_id string, taken_at timestamp"), moments)


def test_history_names_each_moment(spark):
    taken = drawn(1)
    history = whole(spark, taken).cache()
    for moment, names in taken:
        for at in (moment, moment + HOUR / 2, moment + HOUR - timedelta(seconds=1)):
            assert sorted(map(tuple, listing.listed_at(history, at).collect())) == sorted(names)


def test_step_by_step_equals_all_at_once(spark):
    taken = drawn(2, n=7)
    history = spark.createDataFrame([], schemas.schema_of("market_history"))
    for moment, names in taken:
        for _ in range(2):  # a rerun changes nothing
            history = spark.createDataFrame(listing.listing_step(history, pairs(spark, *names), moment).collect(), schemas.schema_of("market_history"))
    first = F.col("valid_from") == F.lit(START)
    expected = whole(spark, taken).withColumn("valid_from", F.when(~first, F.col("valid_from")))
    assert rows(history) == rows(expected)


def test_replay_equals_the_run(spark, config, trades):
    taken = drawn(3)
    made = [(i, *random.choice(MARKETS), 1, 1, 1, None, START + timedelta(minutes=random.randint(0, 12 * 60 - 1))) for i in range(200)]
    made.append((999, "BAD", "U", 1, 1, 1, None, START))
    frame = trades(made)
    live = []
    for moment, names in taken:
        inside = frame.filter((F.col("timestamp") >= F.lit(moment)) & (F.col("timestamp") < F.lit(moment + HOUR)))
        live += [r.trade_id for r in admitted_trades(inside, pairs(spark, *names), config).collect()]
    found = listing.admitted_as_of(frame, whole(spark, [*taken]), config)
    assert found.columns == frame.columns
    assert sorted(r.trade_id for r in found.collect()) == sorted(live) and 0 < len(live) < 200
    text = plan(found)
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.fixture
def jobs(spark, config, tmp_path):
    return Jobs(Store(spark, str(tmp_path / "tables")), config)


def test_jobs_and_stream_follow_the_listing(spark, jobs):
    def pages(*markets):
        return spark.createDataFrame([([(m,) for m in markets],)], schemas.MARKET_LISTING)

    assets = spark.createDataFrame([([("U", "U", "USD"), ("A", "A", "AAA"), ("N", "N", "NAT")],)], schemas.ASSET_LISTING)
    jobs.refresh(START, Landed(asset_pages=assets, market_pages=pages("NAT-USD")))
    jobs.refresh(START + HOUR, Landed(market_pages=pages("NAT-USD", "AAA-USD")))
    jobs.refresh(START + 2 * HOUR, Landed(market_pages=pages("AAA-USD")))
    jobs.refresh(START + 2 * HOUR, Landed(market_pages=pages()))
    assert {r.base_asset_id: r.is_active for r in jobs.store.read("markets").collect()} == {"NAT": False, "AAA": True}
    assert rows(jobs.store.read("market_history")) == [
        ("AAA", "USD", START + HOUR, None), ("NAT", "USD", None, START + 2 * HOUR)
    ]
    minute = timedelta(minutes=1)
    texts = [
        event(1, "NAT-USD", 1, START - 9 * HOUR), event(2, "AAA-USD", 1, START + HOUR - minute), event(3, "AAA-USD", 1, START + HOUR),
        event(4, "NAT-USD", 1, START + 2 * HOUR - minute), event(5, "NAT-USD", 1, START + 2 * HOUR), event(6, "XXX-USD", 1, START),
    ]
    TradeStream(jobs).process(spark.createDataFrame([(t,) for t in texts], "value string"), 0)
    assert [r.trade_id for r in jobs.store.read("trades").orderBy("trade_id").collect()] == [1, 3, 4]


def test_references_read_no_trades(spark, jobs, monkeypatch):
    read = jobs.store.read
    seen = []
    monkeypatch.setattr(jobs.store, "read", lambda table, **given: (seen.append(table), read(table, **given))[1])
    jobs.store.replace("markets", spark.createDataFrame([("AAA", "GONE", True, None), ("AAA", "USD", True, None)], schemas.schema_of("markets")))
    assets = spark.createDataFrame([("AAA",), ("USD",)], "asset_id string")
    absent = {f.name: F.lit(None) for f in schemas.schema_of("assets") if f.name != "asset_id"}
    jobs.store.replace("assets", schemas.conform(assets.withColumns(absent), "assets"))
    jobs.check_references()
    assert "trades" not in seen and "market_panes" in seen
    assert rows(read("orphans")) == [("markets", "quote_asset_id", "GONE", 1)]
