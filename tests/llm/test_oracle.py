"""Registered queries that SQL can express, against their SQL."""

import duckdb
import pytest
from conftest import SF_DIR

from logloom.llm import entry


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    ours, theirs = entry.queries()[name](spark, SF_DIR), connection.sql(entry.oracle_sql()[name])
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    found = sorted(map(str, map(tuple, ours.select(*columns).collect())))
    assert found == sorted(map(str, theirs.select(*columns).fetchall())) and found
