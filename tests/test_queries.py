"""Every registered query against its SQL twin in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from isotherm.queries.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def shown(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = spark_entry.queries()[name](spark, SF_DIR)
    expected = duck.sql(spark_entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows, twins = got.collect(), expected.fetchall()
    assert rows
    assert len(rows) == len(twins)
    assert shown(got.columns, rows) == shown(expected.columns, twins)


def test_every_twin_has_its_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(ORACLE) <= set(spark_entry.queries())


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["object_name", "date", "max_temp", "max_temp_city", "min_temp", "min_temp_city"]
    assert not result.isEmpty()
