import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tradeglass.operators import pricing
from tradeglass.operators.lastknown import choose_slices, last_known

START = datetime(2024, 1, 1)


def one_by_one(rows, stable, seeds=None):
    """Sequential reference: volume and price made, per trade id."""
    prices, out = dict(seeds or {}), {}
    for trade_id, base, quote, price, _, vq, _, _ in sorted(rows, key=lambda r: (r[7], r[0])):
        volume = made = None
        if quote in stable:
            volume, made = float(vq), float(price)
        elif quote in prices:
            volume, made = float(vq) * prices[quote], float(price) * prices[quote]
        if made is not None:
            prices[base] = made
        out[trade_id] = (volume, made)
    return out


def random_trades(markets, n, seed, step=600):
    rng = random.Random(seed)
    rows, ids = [], rng.sample(range(10 * n), n)
    for trade_id in ids:
        base, quote = rng.choice(markets)
        price, quantity = D(rng.randint(50, 200)) / 100, rng.randint(1, 9)
        moment = START + timedelta(seconds=rng.randint(0, n * step))
        rows.append((trade_id, base, quote, price, quantity, price * quantity, None, moment))
    return rows


def compare(priced, expected):
    got = {r.trade_id: (r.volume, r.usd_price) for r in priced.collect()}
    assert set(got) == set(expected)
    for trade_id, (volume, made) in expected.items():
        found_volume, found_made = got[trade_id]
        if volume is None:
            assert found_volume is None and found_made is None
        else:
            assert float(found_volume) == pytest.approx(volume, rel=1e-9, abs=1e-6)
            assert found_made == pytest.approx(made, rel=1e-9)


LAYERED = [("A", "USD"), ("B", "USD"), ("B", "A"), ("C", "A"), ("C", "B"), ("D", "C"), ("E", "NOPRICE"), ("USD", "A"), ("A", "USD")]
CYCLIC = [("A", "USD"), ("A", "B"), ("B", "A"), ("B", "C"), ("C", "A"), ("D", "B"), ("D", "USD"), ("E", "D"), ("F", "F")]


@pytest.mark.parametrize("unit", ["auto", "day", "hour", "minute", "second"])
def test_layered(trades, config, unit):
    rows = random_trades(LAYERED, 300, seed=1)
    compare(pricing.price_trades(trades(rows), config, slices=unit), one_by_one(rows, {"USD"}))


@pytest.mark.parametrize("unit,seed", [("auto", 2), ("day", 3), ("hour", 4)])
def test_cycles(trades, config, unit, seed):
    rows = random_trades(CYCLIC, 250, seed=seed)
    compare(pricing.price_trades(trades(rows), config, slices=unit), one_by_one(rows, {"USD"}))


def test_long_chain_of_one_cycle(trades, config):
    """Two assets quoted in each other only, after one dollar trade: every price hangs on all before."""
    rows = [(0, "A", "USD", D(2), 1, D(2), None, START)]
    for i in range(1, 120):
        base, quote = ("B", "A") if i % 2 else ("A", "B")
        price = D("1.01") if i % 3 else D("0.99")
        rows.append((i, base, quote, price, 1, price, None, START + timedelta(minutes=i)))
    compare(pricing.price_trades(trades(rows), config), one_by_one(rows, {"USD"}))


def test_many_markets_change_nothing(trades, config):
    """Markets of assets that are no quotes are not looked at, so their number does not choose the method."""
    rows = random_trades(LAYERED, 200, seed=5)
    more = [(100_000 + i, f"X{i}", "USD", D(2), 1, D(2), None, START) for i in range(300)]
    alone = {r.trade_id: (r.volume, r.usd_price) for r in pricing.price_trades(trades(rows), config).collect()}
    among = {r.trade_id: (r.volume, r.usd_price) for r in pricing.price_trades(trades(rows + more), config).collect()}
    assert alone == {i: x for i, x in among.items() if i < 100_000}


@pytest.mark.parametrize("markets", [LAYERED, CYCLIC])
def test_seeds(spark, trades, config, markets):
    rows = random_trades(markets, 120, seed=6)
    known = {"A": 3.5, "NOPRICE": 0.25, "B": 1.75}
    seeds = spark.createDataFrame([*known.items(), ("C", None)], "asset_id string, usd_price double")
    compare(pricing.price_trades(trades(rows), config, seeds=seeds), one_by_one(rows, {"USD"}, known))


def test_hot_quote_splits(trades, config):
    rows = random_trades([("A", "USD"), ("B", "A")], 300, seed=7, step=60)
    split = replace(config, rows_per_slice=60)
    hot = trades(rows)
    units = {r.base_asset_id: r._unit for r in choose_slices(hot, ["base_asset_id"], "timestamp", "trade_id", 60).units.collect()}
    assert set(units.values()) <= {"hour", "minute"} and "A" in units
    compare(pricing.price_trades(hot, split), one_by_one(rows, {"USD"}))


def test_all_rows_in_one_second(trades, config):
    """A busy key is cut by id where a second is too full; the other keys stay whole."""
    rows = random_trades([("A", "USD"), ("B", "A"), ("C", "USD"), ("D", "C")], 400, seed=9)
    rows = [(*r[:-1], START) if r[0] % 9 else r for r in rows if r[1] in "AB" or r[0] % 20 == 0]
    split = replace(config, rows_per_slice=20)
    hot = trades(rows)
    slices = choose_slices(hot, ["base_asset_id"], "timestamp", "trade_id", 20)
    assert {r.base_asset_id for r in slices.units.collect()} == {"A", "B"}
    assert all(r._unit == "second" for r in slices.units.collect()) and slices.cuts.count() == 2
    compare(pricing.price_trades(hot, split), one_by_one(rows, {"USD"}))


def test_unpriced_then_priced(trades, config):
    rows = [
        (1, "B", "A", D(2), 1, D(2), None, START),
        (2, "A", "USD", D(3), 1, D(3), None, START + timedelta(seconds=1)),
        (3, "B", "A", D(2), 2, D(4), None, START + timedelta(seconds=2)),
    ]
    priced = {r.trade_id: r for r in pricing.price_trades(trades(rows), config).collect()}
    assert priced[1].volume is None and priced[1].usd_price is None
    assert priced[3].volume == D("12.000000") and priced[3].usd_price == 6.0


def test_quote_levels():
    level, looped = pricing.quote_levels(LAYERED, ("USD",))
    assert (level["A"], level["B"], level["C"], level["D"], level["NOPRICE"], looped) == (1, 2, 3, 4, 1, set())
    level, looped = pricing.quote_levels(CYCLIC, ("USD",))
    assert looped == {"A", "B", "C", "D", "E", "F"}


def test_last_prices(spark, trades, config):
    rows = random_trades(LAYERED, 150, seed=8)
    frame = trades(rows)
    last = {}
    for r in sorted(rows, key=lambda r: (r[7], r[0])):
        last[(r[1], r[2])] = r[3]
    got = {(r[0], r[1]): r[2] for r in pricing.market_last_price(frame).collect()}
    assert got == {k: v.quantize(D("1.0000000000")) for k, v in last.items()}
    priced = pricing.price_trades(frame, config)
    seeds = spark.createDataFrame(
        [("A", 1.0, START, 0), ("ZZ", 2.0, START, 0)], "asset_id string, usd_price double, timestamp timestamp, trade_id bigint"
    )
    prices = {r.asset_id: r.usd_price for r in pricing.asset_last_price(priced, seeds).collect()}
    made = one_by_one(rows, {"USD"})
    expected = {}
    for r in sorted(rows, key=lambda r: (r[7], r[0])):
        if made[r[0]][1] is not None:
            expected[r[1]] = made[r[0]][1]
    assert prices == pytest.approx({**expected, "ZZ": 2.0})


@pytest.mark.parametrize("unit", [None, "day", "hour", "minute", "second"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_last_known(spark, unit, inclusive):
    rng = random.Random(9)
    rows = [
        (rng.choice("ab"), START + timedelta(seconds=rng.randint(0, 400_000)), i, rng.randint(1, 9) if rng.random() < 0.3 else None)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "k string, at timestamp, id bigint, v int")
    got = {r.id: r.w for r in last_known(frame, ["k"], ["at", "id"], "v", "w", slices=unit, inclusive=inclusive).collect()}
    state, expected = {}, {}
    for key, _, row_id, value in sorted(rows, key=lambda r: (r[1], r[2])):
        if not inclusive:
            expected[row_id] = state.get(key)
        if value is not None:
            state[key] = value
        if inclusive:
            expected[row_id] = state.get(key)
    assert got == expected


def test_price_changes(trades, config):
    at = [START + timedelta(minutes=i) for i in range(5)]
    rows = [(i, "A", "USD", p, 1, 1, None, at[i]) for i, p in enumerate([D("1.0"), D("1.00"), D("2"), D("2"), D("1")])]
    changes = pricing.price_changes(trades(rows), config)
    assert sorted(r.trade_id for r in changes.collect()) == [0, 2, 4]


def test_keep_prices(spark):
    listed = spark.createDataFrame([("U", 1.0), ("A", None), ("B", None), ("V", 1.0)], "asset_id string, price double")
    before = spark.createDataFrame([("U", 9.0), ("A", 3.0)], "asset_id string, price double")
    assert {r.asset_id: r.price for r in pricing.keep_prices(listed, before).collect()} == {"U": 9.0, "A": 3.0, "B": None, "V": 1.0}
