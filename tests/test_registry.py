"""The registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry_module.queries())


@needs_data
def test_entry(spark):
    assert entry_module.entry(spark).count() == 31


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    ours = entry_module.queries()[name](spark, SF).toArrow()
    wanted = db.sql(SQL[name]).to_arrow_table()
    types, rows = rows_of(ours)
    wanted_types, wanted_rows = rows_of(wanted)
    assert rows == wanted_rows
    assert [t.replace("large_", "") for t in types] == [t.replace("large_", "") for t in wanted_types]
