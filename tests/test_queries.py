"""Every query with SQL gives what the SQL gives, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from foliomill.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and x != x:
        return "NULL"
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    if isinstance(x, (bool, int, float, str, decimal.Decimal, datetime.date)):
        return repr(x) if isinstance(x, float) else str(x)
    return str(x)


def table(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = table(df.columns, df.collect())
    cursor = duck.execute(registry.ORACLES[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0
