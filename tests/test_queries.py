"""Every query against its SQL counterpart on a second engine."""

import datetime as dt
import decimal
import os

import pytest

import __spark_entry__ as contract
from stellwerk.plans.oracle import ORACLE

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no tables in {SF_DIR}")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6) + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def table(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(plain(r[i]) for i in places)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, engine, name):
    frame = contract.queries()[name](spark, SF_DIR)
    found = table(frame.columns, [tuple(r) for r in frame.collect()])
    answer = engine.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert found == table(columns, answer.fetchall())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
