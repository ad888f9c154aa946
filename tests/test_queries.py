"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import TABLES, table_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    ours = table_of(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        assert ours == table_of([c[0] for c in result.description], result.fetchall())
    else:
        assert ours[1]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(ORACLES) <= set(queries())
