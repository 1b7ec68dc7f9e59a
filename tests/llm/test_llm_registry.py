import duckdb
import pytest

import __spark_entry__
from hourmart.llm.queries import ENTRIES, SCHEMAS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in ENTRIES.items() if sql])
def test_query_equals_its_sql(spark, name):
    run, sql = ENTRIES[name]
    ours = run(spark, SF)
    db = duckdb.connect()
    for table in SCHEMAS:
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = db.sql(sql)
    names = list(found.columns)
    assert sorted(names) == sorted(ours.columns)
    rows = [tuple(r) for r in found.fetchall()]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in ours.select(*names).collect())


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
