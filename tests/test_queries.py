"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def order(row):
    return [(value is None, str(value)) for value in row]


def test_every_query_of_the_engine_has_its_sql():
    assert ORACLE.keys() <= QUERIES.keys()
    for module in entry_points.MODULES:
        if module.__name__.startswith("workload."):
            assert module.QUERIES.keys() == module.ORACLE.keys()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, oracle, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = oracle.execute(ORACLE[name])
    assert sorted(column[0] for column in cursor.description) == columns
    expected = [
        tuple(dict(zip([c[0] for c in cursor.description], row))[name] for name in columns)
        for row in cursor.fetchall()
    ]
    found = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(found, key=order) == sorted(expected, key=order)
    assert found


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["l_orderkey", "l_linenumber", "l_returnflag", "qty", "total_qty"]
    assert result.count() > 0
