"""Tokenising of whole columns against regular expressions."""

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tagloom.llm import batches, toxicity
from tagloom.llm.batches import ALNUM, BLANKS, append_columns, plain, row_slices, split_words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aZ09 .-_\t\n\x0b\x0c\r\x1c\x85\xa0éß漢🫠\x00/:@[`{\x7f"), max_size=30)), max_size=8)
LOWER = {c: c + 32 for c in range(65, 91)}


def by_pattern(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for table, pattern in ((ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), (BLANKS, "[^\x20\x09-\x0d]+")):
        words, rows = split_words(plain(pa.array(texts, pa.string())), table)
        expected = [(i, w) for i, t in enumerate(texts) for w in by_pattern(t, pattern)]
        assert list(zip(rows.tolist(), words.to_pylist(), strict=True)) == expected


def test_slices_cover_all_rows_once():
    texts = plain(pa.array(["a" * 10, None, "b" * 50, "", "c" * 5, "d" * 30]))
    for limit in (1, 12, 60, 1000):
        ranges = list(row_slices(texts, limit))
        assert [i for a, b in ranges for i in range(a, b)] == list(range(6))
    sliced = texts.slice(2, 3)
    assert list(row_slices(sliced, 1000)) == [(0, 3)]
    assert split_words(sliced, ALNUM)[0].to_pylist() == ["b" * 50, "c" * 5]


def test_new_columns_replace_old_ones_of_their_name(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "x y", "old")], "id int, text string, SIZE string")
    field = T.StructField("size", T.LongType())
    out = append_columns(df, "text", [field], lambda texts, batch: [[len(t) for t in texts.to_pylist()]])
    assert out.columns == ["id", "text", "size"]
    assert out.collect()[0]["size"] == 3


def test_the_bound_on_batches_is_lowered_only(spark):
    before = spark.conf.get(batches._BATCH_SETTING)
    for asked, left in (("64m", "8388608b"), ("1m", "1m"), ("8388608", "8388608")):
        spark.conf.set(batches._BATCH_SETTING, asked)
        batches.bound_batches(spark)
        assert spark.conf.get(batches._BATCH_SETTING) == left
    spark.conf.set(batches._BATCH_SETTING, before)


def test_workers_let_go_of_what_other_operators_kept(spark):
    """Automata of a lexicon and loaded piece models stay with a worker only while it runs their own operator."""
    texts = spark.range(64, numPartitions=8).selectExpr("id", "'some text' AS text")

    def held(keeps, make):
        def compute(rows, _):
            if make:
                toxicity._automata(("word",), (1.0,), 400)
            return [[toxicity._automata.cache_info().currsize] * len(rows)]

        rows = append_columns(texts, "text", [T.StructField("held", T.LongType())], compute, *keeps)
        return {r["held"] for r in rows.select("held").collect()}

    assert held([toxicity._automata], True) == {1}
    assert 1 in held([toxicity._automata], False)
    assert held([], False) == {0}
