"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from check_queries import TABLES, compare
from tagloom.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, duck.sql(ORACLE[name])) == ""
    else:
        assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
