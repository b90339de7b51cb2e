"""Transfers in ranges of ids: a delivery is compared with the ranges it falls into, not with the whole history."""

import re
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeglass.plans import store as stores
from tradeglass.plans.store import Store

from test_plans import plan

REQUIRED, ORDER = ["transfer_id", "asset_symbol", "amount"], ["block_num", "event_idx"]


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(stores.RANGES, "fee_withdrawals", ("transfer_id", 10))
    return Store(spark, str(tmp_path))


def transfers(spark, *rows):
    return spark.createDataFrame(list(rows), "transfer_id bigint, asset_symbol string, amount decimal(20,10), block_num bigint, event_idx bigint")


def deliver(store, *rows):
    store.append_new("fee_withdrawals", transfers(store.spark, *rows), REQUIRED, ORDER)


def stored(store):
    return sorted((r.transfer_id, r.amount) for r in store.read("fee_withdrawals").collect())


def test_only_ranges_of_the_delivery_are_read(spark, store):
    for base in range(0, 60, 20):
        deliver(store, *[(base + k, "N", D(1), base, k) for k in range(20)])
    new = store.unseen("fee_withdrawals", transfers(spark, (25, "N", D(9), 1, 1), (47, "N", D(9), 1, 1), (101, "N", D(9), 1, 1)), REQUIRED, ORDER)
    text = plan(new)
    assert re.search(r"PartitionFilters: \[[^]]*id_range IN \(2, ?4, ?10\)", text), text
    assert "GreaterThanOrEqual(transfer_id,25), LessThanOrEqual(transfer_id,101)" in text
    assert [r.transfer_id for r in new.collect()] == [101]
    read = store.read("fee_withdrawals").filter(F.col("id_range").isin([2, 4, 10]))
    assert read.select(F.input_file_name()).distinct().count() == 2


def test_first_delivery_counts_and_a_rerun_adds_nothing(store):
    deliver(store, (1, "N", D(1), 5, 2), (1, "N", D(2), 5, 1), (2, "", D(1), 5, 3), (3, "N", None, 5, 4), (None, "N", D(1), 5, 5))
    assert stored(store) == [(1, D(2))]
    for _ in range(2):
        deliver(store, (1, "N", D(7), 1, 1), (12, "N", D(3), 6, 1), (-4, "N", D(5), 6, 2))
    assert stored(store) == [(-4, D(5)), (1, D(2)), (12, D(3))]
    deliver(store)
    assert len(stored(store)) == 3


def test_many_ranges_are_bounded_not_listed(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "LISTED_RANGES", 3)
    rows = [(k, "N", D(1), k, 0) for k in range(0, 200, 7)]
    deliver(store, *rows)
    again = store.unseen("fee_withdrawals", transfers(spark, *rows, (203, "N", D(1), 1, 1)), REQUIRED, ORDER)
    assert "id_range >= 0" in plan(again) and [r.transfer_id for r in again.collect()] == [203]


def test_ranges_of_many_files_are_written_anew(store):
    for k in range(4):
        deliver(store, (k, "N", D(k), k, 0), (50 + k, "N", D(k), k, 1))
    deliver(store, (30, "N", D(3), 1, 1))
    before = stored(store)
    assert store.compact_ranges("fee_withdrawals", files=2) == [0, 5]
    assert stored(store) == before
    assert {p.name: len(list(p.glob("*.parquet"))) for p in Path(store.root, "fee_withdrawals").glob("id_range=*")} == {"id_range=0": 1, "id_range=3": 1, "id_range=5": 1}
    assert store.compact_ranges("fee_withdrawals", files=2) == []
