"""Every query with an SQL twin, side by side on the smallest tables."""

import duckdb
import pytest
from check_queries import TABLES, rows_of
from table_data import DATA

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, DATA)
    result = db.execute(oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == want


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
