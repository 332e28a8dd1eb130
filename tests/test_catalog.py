"""Every core query runs, and agrees with its SQL where it has one."""

import datetime
import decimal
import os

import pytest

from quern.plans import catalog

NAMES = sorted(catalog.queries())


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def con(data):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, con, name):
    df = catalog.queries()[name](spark, data)
    rows = [tuple(plain(v) for v in r) for r in df.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql:
        columns = ", ".join(f'"{c}"' for c in df.columns)
        want = [tuple(plain(v) for v in r) for r in con.execute(f"select {columns} from ({sql})").fetchall()]
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(catalog.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["stage", "place", "n"]
