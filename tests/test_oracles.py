"""Every registered query of the bar engine against its SQL in DuckDB, and the entry."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from barloom.plans import registry
from tests.conftest import SMALL

registry.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, tables, name):
    frame = registry.QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in frame.collect())
    answer = tables.sql(registry.ORACLES[name])
    assert sorted(answer.columns) == columns
    want = sorted(tuple(_plain(r[answer.columns.index(c)]) for c in columns) for r in answer.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
