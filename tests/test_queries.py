"""Every query against its SQL on the smallest tables."""

import os
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tradeglass.workload.oracle import ORACLE
from tradeglass.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def text(value):
    return str(value.normalize()) if isinstance(value, Decimal) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, SF_DIR)
    names = sorted(frame.columns)
    found = sorted(tuple(map(text, row)) for row in frame.select(*names).collect())
    answer = tables.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == names
    order = [columns.index(c) for c in names]
    assert found == sorted(tuple(text(row[i]) for i in order) for row in answer.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
