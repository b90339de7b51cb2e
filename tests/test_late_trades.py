"""Late trades: what they change is priced again, and the tables of their days are taken anew."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tradeglass import schemas
from tradeglass.operators import daily, pricing
from tradeglass.plans.jobs import Jobs
from tradeglass.plans.store import Store
from tradeglass.schemas import conform
from tradeglass.session import cut_lineage
from tradeglass.streaming.trades import TradeStream

from test_jobs_and_streams import event, landed, rows

START, TODAY = datetime(2024, 1, 8), date(2024, 1, 20)
LAYERED = [("NAT", "USD"), ("AAA", "NAT"), ("BBB", "AAA"), ("BBB", "NAT"), ("CCC", "BBB"), ("AAA", "USD"), ("DDD", "USD")]
CYCLIC = [("NAT", "USD"), ("AAA", "NAT"), ("BBB", "AAA"), ("AAA", "BBB"), ("NAT", "BBB"), ("CCC", "BBB")]


@pytest.fixture
def jobs(spark, config, tmp_path):
    return Jobs(Store(spark, str(tmp_path / "tables")), config)


def prepare_tables(spark, jobs, pairs=LAYERED):
    assets = spark.createDataFrame([(a, a, a, True) for a in ("USD", "NAT", "AAA", "BBB", "CCC", "DDD", "IDL")], "asset_id string, symbol string, name string, is_active boolean")
    figures = {f.name: F.lit(None) for f in schemas.schema_of("assets") if f.name not in assets.columns}
    jobs.store.replace("assets", conform(assets.withColumns(figures), "assets"))
    listed = [(b, q, True, None) for b, q in (*pairs, ("IDL", "USD"))]
    jobs.store.replace("markets", spark.createDataFrame(listed, schemas.schema_of("markets")))
    days = spark.createDataFrame([((START + timedelta(days=k)).date(),) for k in range(8)], "stat_date date")
    absent = {f.name: F.lit(None) for f in schemas.schema_of("exchange_daily") if f.name != "stat_date"}
    jobs.store.replace("exchange_daily", conform(days.withColumns(absent), "exchange_daily"))


def history(trades, pairs, n=60, seed=1):
    random.seed(seed)
    made = []
    for i in range(n):
        base, quote = random.choice(pairs)
        moment = START + timedelta(hours=random.randint(0, 24 * 3), minutes=i % 50)
        # Prices near 1: along a cycle they multiply.
        price, amount = random.choice([D("0.5"), 1, D("1.25"), 2, D("0.8")]), random.randint(1, 5)
        made.append((i, base, quote, price, amount, price * amount, None, moment))
    frame = trades(made)
    return frame.select(*frame.columns, *[F.lit(None).cast("string").alias(c.split()[0]) for c in schemas.TRADE_IDS.split(", ")])


def fresh_tables(store, markets, assets, days):
    panes = store.read("market_panes")
    traded = daily.traded_pairs(store.read("trades"))
    per_market, per_asset = [], []
    for day in days:
        per_market += rows(daily.markets_daily(store.read("trades"), markets, day, traded=traded))
        per_asset += rows(daily.assets_daily(store.read("trades"), assets, day).select("stat_date", "asset_id", "volume", "trades"))
    closed = store.read("exchange_daily")
    for day in days:
        closed = daily.exchange_daily_close(closed, panes, day)
    return sorted(per_market, key=str), sorted(per_asset, key=str), rows(closed)


def check_day_tables(store, days):
    markets, assets = store.read("markets"), store.read("assets")
    per_market, per_asset, per_day = fresh_tables(store, markets, assets, days)
    chosen = F.col("stat_date").isin(*days)
    assert rows(store.read("markets_daily").select(*[f.name for f in schemas.schema_of("markets_daily")]).filter(chosen)) == per_market
    found = store.read("assets_daily").select("stat_date", "asset_id", "volume", "trades").filter(chosen)
    assert rows(found) == per_asset
    assert rows(store.read("exchange_daily")) == per_day
    total = store.read("exchange_daily").agg(F.sum("volume").cast(schemas.USD_TOTAL), F.sum("trades")).first()
    assert store.read("exchange_alltime").first()[:2] == total[:]


def test_late_trades_renew_their_day_tables(spark, jobs, trades, config):
    prepare_tables(spark, jobs)
    whole = cut_lineage(history(trades, LAYERED))
    late = F.col("trade_id") % 4 == 0
    jobs.backfill(whole.filter(~late))
    days = jobs.settle_days(TODAY)
    assert days == sorted(jobs.store.partitions("trades")) and jobs.store.touched_days() == []
    check_day_tables(jobs.store, days)
    moved = whole.filter(late & F.col("timestamp").between(*[F.lit(str(START + timedelta(days=d))).cast("timestamp") for d in (1, 2)]))
    jobs.ingest(cut_lineage(pricing.price_trades(moved, config)))
    jobs.reprice_from((START + timedelta(days=1)).date())
    touched = jobs.settle_days(TODAY)
    assert touched and touched != days and (START + timedelta(days=1)).date() in touched
    check_day_tables(jobs.store, days)
    assert jobs.settle_days(TODAY) == []


def test_the_figures_of_a_past_day_stay(spark, jobs, trades, config):
    prepare_tables(spark, jobs)
    whole = cut_lineage(history(trades, LAYERED))
    jobs.backfill(whole.filter("trade_id > 9"))
    jobs.settle_days(TODAY)
    before = {(r.stat_date, r.asset_id): r.price for r in jobs.store.read("assets_daily").collect()}
    jobs._save_prices(spark.createDataFrame([("NAT", 77.0)], "asset_id string, usd_price double"))
    jobs.ingest(cut_lineage(pricing.price_trades(whole.filter("trade_id <= 9"), config)))
    jobs.settle_days(TODAY)
    after = {(r.stat_date, r.asset_id): r.price for r in jobs.store.read("assets_daily").collect()}
    assert {key: after[key] for key in before} == before and D(77) not in before.values()


def test_todays_entry_waits_for_tomorrow(spark, jobs, trades, config):
    prepare_tables(spark, jobs)
    jobs.backfill(history(trades, LAYERED))
    last = max(jobs.store.partitions("trades"))
    done = jobs.settle_days(last)
    assert last not in done and [t.days for t in jobs.store.touched_days()] == [[last]]
    assert jobs.settle_days(last) == [] and len(jobs.store.touched_days()) == 1
    assert jobs.settle_days(last + timedelta(days=1)) == [last] and jobs.store.touched_days() == []
    # What retention has cut into is left as it is.
    jobs.store.mark_days({last}, kept=True)
    assert jobs.settle_days(last + timedelta(days=config.trade_retention_days)) == []


def test_a_driver_lost_between_merge_and_panes_loses_no_day(spark, jobs, trades, config, monkeypatch):
    prepare_tables(spark, jobs)
    whole = cut_lineage(history(trades, LAYERED))
    jobs.backfill(whole.filter("trade_id % 3 > 0"))
    days = jobs.settle_days(TODAY)

    def lost(merged):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, "_add_panes", lost)
    monkeypatch.setattr(jobs, "_add_closes", lost)
    monkeypatch.setattr(jobs, "_add_asset_closes", lost)
    with pytest.raises(RuntimeError):
        jobs.ingest(cut_lineage(pricing.price_trades(whole.filter("trade_id % 3 = 0"), config)))
    monkeypatch.undo()
    other = Jobs(jobs.store, config)
    assert [t.kept for t in other.store.touched_days()] == [False]
    assert other.settle_days(TODAY)
    assert other.store.read("market_panes").agg(F.sum("trades")).first()[0] == whole.count()
    check_day_tables(other.store, sorted(set(days) | set(other.store.partitions("trades"))))


def volumes(frame):
    return {r.trade_id: (r.volume, None if r.usd_price is None else round(r.usd_price, 9)) for r in frame.collect()}


@pytest.mark.parametrize(("pairs", "seed"), [(LAYERED, 1), (LAYERED, 2), (CYCLIC, 3)])
def test_late_repricing_equals_a_full_run(spark, jobs, trades, config, pairs, seed):
    prepare_tables(spark, jobs, pairs)
    whole = cut_lineage(history(trades, pairs, seed=seed))
    late = F.col("trade_id") % 11 == seed
    jobs.backfill(whole.filter(~late))
    moved = cut_lineage(pricing.price_trades(whole.filter(late), config))
    jobs.ingest(moved)
    jobs.reprice_late(moved)
    want = volumes(pricing.price_trades(whole, config))
    assert volumes(jobs.store.read("trades")) == want
    newest = pricing.asset_last_price(jobs.store.read("trades")).select("asset_id", F.col("usd_price").cast(schemas.PRICE))
    kept = {r.asset_id: r.price for r in jobs.store.read("assets").collect()}
    assert all(abs(kept[r[0]] - r[1]) < D("1e-8") for r in newest.collect())


def test_a_leaf_market_is_priced_again_alone(spark, jobs, trades, config, monkeypatch):
    prepare_tables(spark, jobs)
    whole = cut_lineage(history(trades, LAYERED, n=100))
    leaf = whole.filter("base_asset_id = 'CCC'").agg(F.min_by("trade_id", "timestamp")).first()[0]
    jobs.backfill(whole.filter(F.col("trade_id") != leaf))
    moved = cut_lineage(pricing.price_trades(whole.filter(F.col("trade_id") == leaf), config))
    jobs.ingest(moved)
    priced = []
    merge = jobs.merge
    monkeypatch.setattr(jobs, "merge", lambda rows, **given: (priced.append(rows.count()), merge(rows, **given))[1])
    days = jobs.reprice_late(moved)
    assert priced == [1] and len(days) == 1
    assert volumes(jobs.store.read("trades")) == volumes(pricing.price_trades(whole, config))


def test_repricing_ends_where_prices_meet_again(spark, jobs, trades, config, monkeypatch):
    prepare_tables(spark, jobs)
    made = []
    for k in range(5):
        day = START + timedelta(days=k)
        made += [(10 * k, "NAT", "USD", 2 + k, 1, 2 + k, None, day), (10 * k + 1, "AAA", "NAT", 3, 1, 3, None, day + timedelta(hours=9))]
    extra = (99, "NAT", "USD", 7, 1, 7, None, START + timedelta(days=1, hours=5))
    text = [F.lit(None).cast("string").alias(c.split()[0]) for c in schemas.TRADE_IDS.split(", ")]
    whole = trades([*made, extra])
    whole = cut_lineage(whole.select(*whole.columns, *text))
    jobs.backfill(whole.filter("trade_id < 99"))
    moved = cut_lineage(pricing.price_trades(whole.filter("trade_id = 99"), config))
    jobs.ingest(moved)
    seen = []
    reprice = pricing.reprice_day
    monkeypatch.setattr(pricing, "reprice_day", lambda stored, *given: (seen.append(stored.first().timestamp.day), reprice(stored, *given))[1])
    jobs.reprice_late(moved)
    # The next day opens with the late price and ends with its own: the day after is not read.
    assert seen == [9, 10]
    assert volumes(jobs.store.read("trades")) == volumes(pricing.price_trades(whole, config))


def test_stream_that_follows_late_trades(spark, jobs, tmp_path, trades):
    jobs.refresh(datetime(2024, 1, 30, 12, 3), landed(spark))
    start, stream = datetime(2024, 1, 29, 1), TradeStream(jobs, follow_late=True)
    minute = timedelta(minutes=1)
    batches = [
        [event(1, "NAT-USD", 3, start), event(2, "AAA-NAT", 2, start + 9 * minute)],
        [event(3, "NAT-USD", 5, start + 20 * minute), event(4, "AAA-NAT", 2, start + timedelta(days=1))],
        # Late, before the second trade; and one in time, whose price is that of trade 3.
        [event(5, "NAT-USD", 4, start + 5 * minute), event(6, "AAA-NAT", 1, start + timedelta(days=1, hours=1))],
        [event(7, "AAA-NAT", 6, start + 2 * minute), event(8, "AAA-NAT", 7, start - 2 * minute), event(9, "NAT-USD", 8, start + timedelta(days=1, hours=2))],
        [event(10, "AAA-NAT", 1, start + timedelta(days=1, hours=3))],
    ]
    for number, texts in enumerate(batches):
        frame = spark.createDataFrame([(t,) for t in texts], "value string")
        stream.process(frame, number)
        if number == 2:  # once more, as after a lost driver
            stream.process(frame, number)
    found = {r.trade_id: r.volume for r in jobs.store.read("trades").collect()}
    assert found == {1: 3, 2: 8, 3: 5, 4: 10, 5: 4, 6: 5, 7: 18, 8: None, 9: 8, 10: 8}
    assert {r.asset_id: r.price for r in jobs.store.read("assets").collect()} == {"NAT": 8, "AAA": 8, "USD": 1}
    assert {r.base_asset_id: r.price for r in jobs.store.read("markets").collect()} == {"NAT": 8, "AAA": 1}
