"""Every registered query beside its SQL on the given tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_file
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, database, name):
    frame = entry_file.queries()[name](spark, sf_dir)
    found = normalised(frame.columns, [tuple(row) for row in frame.collect()])
    result = database.execute(entry_file.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert found == normalised(names, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(QUERIES) <= set(entry_file.oracle_sql())


def test_entry(spark):
    assert entry_file.entry(spark).columns == ["ticker", "m_price_change_last_day_pct"]
