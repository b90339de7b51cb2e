"""Queries with SQL give its rows."""

import duckdb
import pytest

from tradeglass.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_its_sql(llm, name):
    frame = QUERIES[name](llm, SF)
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    answer = connection.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(str, answer.fetchall())) == sorted(str(tuple(r)) for r in frame.select(*columns).collect())
