"""Every registered query against its expected SQL, and rules on the plans."""

import duckdb
import pytest

import __spark_entry__ as contract
from reviewsieve.plans import catalog, expected_sql
from tests.conftest import SF_SMALL

TABLES = ("documents", "pages", "conversations", "events", "labels")
QUERIES = catalog.queries()
EXPECTED = expected_sql.expected()


@pytest.fixture(scope="module")
def engine():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    return db


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(contract.queries()) and set(EXPECTED) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(EXPECTED))
def test_query_equals_expected_sql(spark, engine, name):
    df = QUERIES[name](spark, SF_SMALL)
    result = engine.execute(EXPECTED[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert costly not in plan


def test_entry_has_rows_and_no_repeats(spark):
    df = contract.entry(spark)
    hashes = [r.review_hash for r in df.collect()]
    assert hashes and len(hashes) == len(set(hashes))
