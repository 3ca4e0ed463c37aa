"""Every registered query against its SQL counterpart in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from checks import oracles, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()
# Spark's type names of DuckDB's.
SAME_TYPE = {
    "VARCHAR": {"string"}, "BIGINT": {"bigint"}, "INTEGER": {"int"}, "DOUBLE": {"double"},
    "BOOLEAN": {"boolean"}, "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def as_sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[at]) for at in order) for row in rows), key=lambda row: tuple(map(repr, row)))


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    types = {column[0]: str(column[1]) for column in expected.description}
    rows = expected.fetchall()
    assert sorted(result.columns) == sorted(columns)
    for column, kind in result.dtypes:
        assert kind in SAME_TYPE[types[column]], (column, kind, types[column])
    found = as_sorted([tuple(row) for row in result.collect()], result.columns)
    wanted = as_sorted(rows, columns)
    assert len(found) == len(wanted) > 0
    different = [pair for pair in zip(found, wanted) if pair[0] != pair[1]]
    assert not different, (len(different), sorted(columns), different[:3])
