"""Totals after batches that come late, twice or half."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom.llm import catalog, token_rollup
from tagloom.operators.sizing import staging_path

ROWS = [("a", "en", 5, 20), ("a", "en", 7, 30), ("b", None, None, 4), (None, "fr", 2, None)]
DOCS = "source string, lang string, t bigint, n_chars bigint"


@pytest.fixture
def rollup(spark):
    return token_rollup.Rollup(spark, staging_path(spark, "test_rollup"))


def totals(rollup):
    return {tuple(r[c] for c in token_rollup.GROUP): tuple(r[m] for m in token_rollup.MEASURES) for r in rollup.totals().collect()}


def test_batches(spark, rollup):
    docs = spark.createDataFrame(ROWS, DOCS)
    assert totals(rollup) == {}
    load = token_rollup.signed(docs, 1, "v1", "t")
    assert rollup.commit("load", load) and not rollup.commit("load", load)
    first = {("a", "en", "v1"): (2, 12, 50), ("b", None, "v1"): (1, 0, 4), (None, "fr", "v1"): (1, 2, 0)}
    assert totals(rollup) == first
    rollup.compact()
    assert totals(rollup) == first and not rollup.commit("load", load)
    revised = token_rollup.signed(docs.filter("t = 7"), -1, "v1", "t").unionByName(
        token_rollup.signed(docs.filter("t = 7").withColumn("t", F.lit(9)), 1, "v2", "t")
    )
    assert rollup.commit("revise", revised)
    want = first | {("a", "en", "v1"): (1, 5, 20), ("a", "en", "v2"): (1, 9, 30)}
    assert totals(rollup) == want
    rollup.compact()
    rollup.compact()
    assert rollup.commit("nothing", load.limit(0)) and totals(rollup) == want
    assert rollup.commit("again", load.withColumn("sign", F.lit(None).cast("int"))) and totals(rollup) == want


def test_a_batch_that_died_counts_for_nothing_and_is_written_anew(spark, rollup):
    load = token_rollup.signed(spark.createDataFrame(ROWS, DOCS), 1, "v1", "t")
    rollup.commit("load", load)
    want = totals(rollup)
    path = rollup._path("batches", "load").removeprefix("file:")
    (Path(path) / "_SUCCESS").unlink()
    assert totals(rollup) == {}
    assert rollup.commit("load", load) and totals(rollup) == want


def test_names(rollup, spark):
    with pytest.raises(ValueError):
        rollup.commit("../x", token_rollup.signed(spark.createDataFrame([], DOCS), 1, "v", "t"))


@pytest.mark.parametrize("name", ["..", ".", "_x", ".x", "-x", ""])
def test_names_that_spark_would_hide_or_follow(rollup, spark, name):
    load = token_rollup.signed(spark.createDataFrame(ROWS, DOCS), 1, "v", "t")
    rollup.commit("load", load)
    with pytest.raises(ValueError):
        rollup.commit(name, load)
    assert sum(v[0] for v in totals(rollup).values()) == 4


def test_a_batch_committed_while_others_are_compacted_counts_once(spark, rollup, monkeypatch):
    load = token_rollup.signed(spark.createDataFrame(ROWS, DOCS), 1, "v", "t")
    rollup.commit("first", load)
    whole = rollup._sums

    def meanwhile(*listed):
        rollup.commit("second", load)
        return whole(*listed)

    monkeypatch.setattr(rollup, "_sums", meanwhile)
    rollup.compact()
    monkeypatch.undo()
    assert sum(v[0] for v in totals(rollup).values()) == 8
    rollup.compact()
    assert sum(v[0] for v in totals(rollup).values()) == 8 and not rollup.commit("second", load)


def test_long_runs_of_blanks(spark, monkeypatch):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    if not Path(path).exists():
        pytest.skip("tokenizers are not here")
    encoding = token_rollup._encoding(Path(path).read_bytes())
    texts = ["a" + " " * 40 + "b", " " * 30, "\n" * 25 + "x", "x \t\n" * 9 + "y", " \u3000" * 15 + "\x1c.", "é" + "\xa0" * 21, "a  b   c"]
    want = [len(encoding.encode_ordinary(t)) for t in texts]
    monkeypatch.setattr(token_rollup, "_LONG", token_rollup.re.compile(token_rollup._BLANK + "{3,}"))
    monkeypatch.setattr(token_rollup, "LONG_RUN", 3)
    assert [token_rollup.count_tokens(encoding, t) for t in texts] == want
    monkeypatch.undo()
    df = spark.createDataFrame([("a" + " " * 3_000_000 + "b",), ("x" * 500_000,)], "text string")
    assert all(r["v"] > 0 for r in token_rollup.with_token_counts(df, path, "v").collect())


def test_token_counts(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    if not Path(path).exists():
        pytest.skip("tokenizers are not here")
    rows = [(1, "Hello world, <|endoftext|> é漢", "en"), (1, None, "en"), (None, "", None), (3, "x " * 20_000, "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = token_rollup.with_token_counts(df.withColumn("V", F.lit(1)), path, "v").collect()
    from tokenizers import Tokenizer

    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    own.encode_special_tokens = True
    want = Counter((i, len(own.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["v"]) for r in out) == want
    some = token_rollup.with_token_counts(df, path, "v", where="lang <> 'en'").collect()
    assert sorted(r["v"] is None for r in some) == [False, True, True, True]


def test_one_pass_for_all_versions(spark, tmp_path, monkeypatch):
    """A task of the query feeds one Python worker, which gets a text once and sends none back."""
    paths = {v: f"/opt/tokenizers/{v}.tiktoken" for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    if not all(Path(p).exists() for p in paths.values()):
        pytest.skip("tokenizers are not here")
    docs = [(1, "a", "en", 9, "Some words"), (1, "a", "fr", 9, "été à Paris"), (2, "a", "de", 3, None), (None, None, None, None, "x  y"), (3, "b", "fr", 5, "é漢")]
    spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 0.0), (None, 0.0)], "doc_id bigint, quality double").write.parquet(f"{tmp_path}/labels.parquet")
    plans, kept = [], catalog.staged

    def watched(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, *rest)

    monkeypatch.setattr(catalog, "staged", watched)
    answer = catalog.QUERIES["op9_token_rollup"](spark, str(tmp_path)).collect()
    got = {tuple(r[c] for c in token_rollup.GROUP): tuple(r[m] for m in token_rollup.MEASURES) for r in answer}
    sent, given = plans[0].split("run(")[1].split("\n")[0].split(")#")
    assert len(plans) == 1 and plans[0].count("run(") == 1
    assert sent.count("text") == 1 and "text" not in given
    one, many = (token_rollup._encoding(Path(p).read_bytes()) for p in paths.values())
    first, second = paths
    assert got == {
        ("a", "en", first): (1, len(one.encode_ordinary("Some words")), 9),
        ("a", "fr", first): (0, 0, 0),
        ("a", "fr", second): (1, len(many.encode_ordinary("été à Paris")), 9),
        ("a", "de", first): (0, 0, 0),
        ("a", "de", second): (1, 0, 3),
        (None, None, first): (1, len(one.encode_ordinary("x  y")), 0),
        ("b", "fr", first): (0, 0, 0),
    }


@pytest.mark.parametrize("keep", [True, False])
def test_versions_count_as_they_would_alone(spark, keep):
    paths = [f"/opt/tokenizers/{v}.tiktoken" for v in ("byte_bpe_50k", "byte_bpe_multi_50k")]
    if not all(Path(p).exists() for p in paths):
        pytest.skip("tokenizers are not here")
    rows = [(1, "Hello, été", "en"), (1, None, "fr"), (None, "x  y", None), (2, "漢字 a", "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    alone = token_rollup.with_token_counts(token_rollup.with_token_counts(df, paths[0], "v", where="lang = 'en'"), paths[1], "w", where="lang = 'fr'")
    both = token_rollup.with_versions(df, [("v", paths[0], "lang = 'en'"), ("w", paths[1], "lang = 'fr'")], keep_text=keep)
    want = alone if keep else alone.drop("text")
    assert both.columns == want.columns and Counter(both.collect()) == Counter(want.collect())
