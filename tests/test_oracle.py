"""Every catalog query against the same query in SQL, on whole tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from sievetally.plans.catalog import QUERIES
from sievetally.plans.oracles import ORACLES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([comparable(row[i]) for i in order]) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(found) == len(expected) and len(found) > 0
    assert found == expected


DUCK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_types_match_sql(spark, duck, name):
    expected = {
        column: DUCK_TYPES.get(dtype, dtype.lower())
        for column, dtype, *_ in duck.execute("DESCRIBE " + ORACLES[name]).fetchall()
    }
    found = dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    assert found == expected


KNOWN_ROWS = {"daily_totals": (2774, 3030), "employee_etl": (974, 3786)}


@pytest.mark.parametrize("name", sorted(KNOWN_ROWS))
def test_known_row_counts(spark, name):
    small, large = KNOWN_ROWS[name]
    assert QUERIES[name](spark, SF).count() == small
    assert QUERIES[name](spark, "/root/testdata/sf0.1").count() == large


def test_entry_runs(spark):
    assert entry(spark).columns == ["customer_id", "transaction_date", "total_amount", "transaction_count"]
    assert entry(spark).count() > 0
