"""Every query against its SQL in DuckDB, over the whole tables."""

from __future__ import annotations

import re

import oracle
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    without = {n for n in set(QUERIES) - set(SQL) if not re.match(r"op\d+_|pipeline$", n)}
    assert not without


@pytest.mark.parametrize("name", sorted(set(SQL) - {n for n in SQL if re.match(r"op\d+_", n)}))
def test_query_matches_sql(spark, sf_dir, connection, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = oracle.duckdb_rows(connection, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.columns == ["origin_port", "destination_port", "count"]
    result.collect()
