"""Tables in buckets: an update touches the buckets of its markets only."""

from datetime import datetime, timedelta
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeglass import schemas
from tradeglass.plans.jobs import Jobs
from tradeglass.plans.store import BUCKETED, Store
from tradeglass.sources.orderbook import book_of

from test_plans import plan

AS_OF = datetime(2024, 1, 30, 12)


@pytest.fixture
def jobs(spark, config, tmp_path):
    return Jobs(Store(spark, str(tmp_path / "tables")), config)


def pages(spark, number, markets):
    """A snapshot of (market, prices)."""
    rows = [(m, number, 1, [(str(p), str(number), "Ask", f"{m}{p}") for p in prices]) for m, prices in markets.items()]
    return spark.createDataFrame(rows, schemas.ORDERBOOK_PAGE)


def book(store):
    return {(r.base_asset_id, int(r.price)): int(r.quantity) for r in store.read("orderbook").collect()}


def files(store):
    return {str(p) for p in Path(store.root, "orderbook").rglob("*.parquet")}


def test_an_update_of_one_market_rewrites_one_bucket(spark, jobs):
    store = jobs.store
    whole = {f"M{i}-U": [1, 2, 3] for i in range(30)}
    jobs.update_book(pages(spark, 1, whole), AS_OF)
    before, located = files(store), store._located("orderbook")
    assert len(located) > 10 and set(located.values()) == {0}
    jobs.update_book(pages(spark, 2, {"M7-U": [2, 4]}), AS_OF)
    bucket = store.buckets_of("orderbook", spark.createDataFrame([("M7", "U")], "base_asset_id string, quote_asset_id string"))
    assert {b for b, v in store._located("orderbook").items() if v == 1} == set(bucket)
    added = files(store) - before
    assert added and all(f"/v=1/bucket={bucket[0]}/" in f for f in added)
    want = {(m.split("-")[0], p): 1 for m in whole for p in (1, 2, 3) if m != "M7-U"} | {("M7", 2): 2, ("M7", 4): 2}
    assert book(store) == want


def test_a_cleared_market_and_an_empty_bucket(spark, jobs):
    jobs.update_book(pages(spark, 1, {"A-U": [1], "B-U": [1]}), AS_OF)
    jobs.update_book(pages(spark, 2, {"A-U": []}), AS_OF)
    assert book(jobs.store) == {("B", 1): 1}
    jobs.update_book(pages(spark, 3, {"B-U": []}), AS_OF)
    assert book(jobs.store) == {} and jobs.store.read("orderbook").columns == [f.name for f in schemas.schema_of("orderbook")]
    jobs.update_book(pages(spark, 4, {"B-U": [5]}), AS_OF)
    assert book(jobs.store) == {("B", 5): 4}


def test_scan_of_one_market_reads_one_folder(spark, jobs):
    jobs.update_book(pages(spark, 1, {f"M{i}-U": [1, 2] for i in range(30)}), AS_OF)
    found = book_of(jobs.store.read_buckets("orderbook"), "M3", "U", BUCKETED["orderbook"][1])
    assert "PartitionFilters: [isnotnull(bucket), (bucket = " in plan(found)
    assert len(found.inputFiles()) > 1 and found.select(F.input_file_name()).distinct().count() == 1
    assert sorted(r.price for r in found.collect()) == [D(1), D(2)]


def test_a_write_without_its_versions_does_not_count(spark, jobs, monkeypatch):
    store = jobs.store
    jobs.update_book(pages(spark, 1, {"A-U": [1], "B-U": [1]}), AS_OF)
    monkeypatch.setattr(store, "replace", lambda *given, **named: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        jobs.update_book(pages(spark, 2, {"A-U": [9]}), AS_OF)
    monkeypatch.undo()
    assert book(store) == {("A", 1): 1, ("B", 1): 1}
    jobs.update_book(pages(spark, 3, {"A-U": [4]}), AS_OF)
    assert book(store) == {("A", 4): 3, ("B", 1): 1}


def test_old_versions_go_and_held_ones_stay(spark, jobs):
    store = jobs.store
    jobs.update_book(pages(spark, 1, {"A-U": [1], "B-U": [1]}), AS_OF)
    held = store.read("orderbook")
    for number in range(2, 5):
        jobs.update_book(pages(spark, number, {"A-U": [number]}), AS_OF)
    assert {int(r.price) for r in held.collect()} == {1}
    store.version_age = timedelta(seconds=-5)
    jobs.update_book(pages(spark, 9, {"A-U": [9]}), AS_OF)
    assert book(store) == {("A", 9): 9, ("B", 1): 1}
    # The first version still holds B's bucket; those between are gone.
    names = sorted(p.parent.parent.name for p in Path(store.root, "orderbook").rglob("*.parquet"))
    assert set(names) == {"v=0", "v=3", "v=4"}
    assert len(list(Path(store.root, "orderbook", "v=0").glob("bucket=*"))) == 1
