"""Every registered query against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [
        tuple(
            "NaN" if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order
        )
        for row in rows
    ]
    return sorted(cells, key=repr)


_KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    expected_types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()

    assert {c: _KINDS[t] for c, t in df.dtypes} == expected_types
    actual = [tuple(row) for row in df.collect()]
    assert len(actual) == len(expected) > 0
    assert _comparable(actual, df.columns) == _comparable(expected, names)


def test_all_are_registered():
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.items() <= contract.oracle_sql().items()


def test_entry_returns_rows(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "zone_id", "year", "month", "total_trips",
        "total_revenue", "avg_fare", "avg_tip", "revenue_per_mile",
    ]
    assert df.count() > 0
