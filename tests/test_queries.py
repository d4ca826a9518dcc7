"""Every registered query of the library against its SQL statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import canonical
from workload.registry import ORACLES, QUERIES, TABLES, runnable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    return con


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 7


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = runnable(name)(spark, SF)
    columns = sorted(df.columns)
    got = canonical([tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()])
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert got == canonical([tuple(r[i] for i in order) for r in result.fetchall()])
