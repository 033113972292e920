"""Every registered query against its SQL, and the line derivation itself."""

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from checks import oracle, queries
from checks.lines import ORACLE_LINES, access_log_from_events, table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    texts = (tuple(None if v[i] is None else str(v[i]) for i in order) for v in values)
    return sorted(texts, key=repr)


def test_both_sides_start_from_equal_lines(spark, sql):
    ours = access_log_from_events(table(spark, SF_DIR, "events")).collect()
    theirs = sql.sql(ORACLE_LINES).fetchall()
    assert sorted((r.event_id, r.value) for r in ours) == sorted(theirs)


def test_every_query_has_sql():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert queries.queries().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", queries.queries())
def test_query(spark, sql, name):
    ours = contract.queries()[name](spark, SF_DIR)
    theirs = sql.sql(oracle.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    found = rows(ours.columns, [tuple(r) for r in ours.collect()])
    assert found == rows(theirs.columns, theirs.fetchall())
    assert found
