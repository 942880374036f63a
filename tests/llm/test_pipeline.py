"""Queries against their twins on the smallest tables, and the stages one by one."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from check_queries import TABLES, compare
from tagloom.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, duck.sql(ORACLE[name])) == ""
    else:
        assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        left = docs.count()
        assert 0 < left <= seen
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        seen = left
    assert docs.columns == [c for c in columns if c != "text"] + ["pieces"]
    assert docs.count() == corpus_pipeline.run(spark, SF).count()


def test_stages_take_odd_and_empty_tables(spark):
    own = "_hash string, SCORE int, kept int, items string, `a.b` int, carried int, fingerprint string, Pieces int"
    extra = ("h", 5, 6, "i", 7, 8, "f", 9)
    odd = spark.createDataFrame(
        [(1, None, "en", None, 0, *extra), (1, "", None, "s", None, *extra), (None, "same words here", "en", "s", 1, *extra), (None, "same words here", "en", "s", 1, *extra)],
        f"doc_id bigint, text string, lang string, source string, n_chars bigint, {own}",
    )
    for docs in (odd, odd.limit(0)):
        names, some = docs.columns, docs.count() > 0
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == names
            assert {tuple(r)[5:] for r in docs.collect()} == ({extra} if some else set())
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.columns == [c for c in names if c not in ("text", "Pieces")] + ["pieces"]
        assert {tuple(r)[4:-1] for r in last.collect()} == ({extra[:-1]} if some else set())
