"""Every query against SQL run by another engine, exactly, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.sources.landing import LANDING_TABLES
from tests.conftest import SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def other_engine():
    connection = duckdb.connect()
    for table in LANDING_TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_all_have_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) <= set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(entry.LLM_QUERIES)))
def test_query(spark, warehouse, other_engine, name):
    found = QUERIES[name](spark, SMALL)
    expected = other_engine.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in found.columns]
    left = sorted((tuple(r) for r in found.collect()), key=repr)
    right = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert left == right


def test_hash_buckets_cover_every_customer(spark, warehouse):
    found = QUERIES["hash_bucket_assign"](spark, SMALL).collect()
    assert len(found) == warehouse.landing("customer").count()
    assert all(0 <= r.bucket < 20 for r in found)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
