"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from beatlake.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(name, spark):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = duck.execute(queries.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    found = queries.queries()[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))
