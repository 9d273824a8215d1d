"""The queries that SQL can express, against their SQL."""

import duckdb
import pytest

from siltstone.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(queries.SQL[name])
    columns = [d[0] for d in found.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(found.fetchall(), key=str)
