"""Every registered query against its SQL equivalent, on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from check import TABLES, rows_of
from starbrook.plans import catalog, oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
STATEMENTS = oracles.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_statement_belongs_to_a_query():
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(QUERIES) - set(STATEMENTS) == {"schema_check", "table_footprint", "archival_report"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    found = rows_of(df.columns, df.collect())
    assert found[1]
    if name in STATEMENTS:
        result = db.execute(STATEMENTS[name])
        assert found == rows_of([c[0] for c in result.description], result.fetchall())


def test_all_are_registered():
    assert set(QUERIES) <= set(registry.queries()) and set(STATEMENTS) <= set(registry.oracle_sql())


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["rank", "product_id", "view_count"] and df.count() == 10
