"""Every registered query with an SQL twin gives the rows that DuckDB gives."""

import datetime
import decimal
import math

import duckdb
import pytest

from yearmask.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    got = registry.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(map(plain, r))) for r in got.select(columns).collect())
    if name not in registry.ORACLES:
        assert rows
        return
    result = duck.execute(registry.ORACLES[name])
    assert sorted(c[0] for c in result.description) == columns
    order = [[c[0] for c in result.description].index(c) for c in columns]
    assert rows == sorted(repr(tuple(plain(r[i]) for i in order)) for r in result.fetchall())


def test_queries_without_a_twin_are_few():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"a24_input_manifest"}
