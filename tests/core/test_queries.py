"""Every registered query against its SQL, run by another engine on the same tables."""

import math
import os

import duckdb
import pytest

from siltstone.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return f"{float(value):.9g}" if isinstance(value, int) or type(value).__name__ == "Decimal" else str(value)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    rows = got.collect()
    if name not in queries.SQL:
        assert rows
        return
    found = duck.execute(queries.SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in found.fetchall())
    have = sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in rows)
    assert len(have) == len(want)
    assert [(a, b) for a, b in zip(have, want) if a != b][:3] == []
