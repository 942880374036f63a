"""Lemmas and entities, for tables that fit a task and for joined ones."""

import pytest

from tagloom.operators.lexicon import extract_entities, lemmatize

BOTH = pytest.mark.parametrize("limit", [1000, 0])


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, "Мамы мыли рамы, мамы!"), (2, "unknown words"), (3, ""), (4, None), (5, "New York and York City; new york")]
    return spark.createDataFrame(rows, "id bigint, text string")


@BOTH
def test_lemmas(spark, texts, limit):
    lexicon = spark.createDataFrame([("мамы", "мама"), ("мыли", "мыть"), ("рамы", "рама"), ("words", None)], "token string, lemma string")
    got = {r.id: r.lemmas for r in lemmatize(texts, lexicon, key="id", max_lexicon_rows=limit).collect()}
    assert got == {1: "мама мыть рама мама", 2: "", 3: "", 4: "", 5: ""}


@BOTH
def test_lexicon_must_be_unique(spark, texts, limit):
    twice = spark.createDataFrame([("a", "b"), ("a", "c")], "token string, lemma string")
    with pytest.raises(ValueError, match="more than one row"):
        lemmatize(texts, twice, key="id", max_lexicon_rows=limit)


@BOTH
def test_entities(spark, texts, limit):
    names = spark.createDataFrame([("New York",), ("York",), ("York City",), ("мамы",)], "name string")
    got = {r.id: r.entities for r in extract_entities(texts, names, key="id", max_gazetteer_rows=limit).collect()}
    assert got == {1: ["мамы", "мамы"], 2: [], 3: [], 4: [], 5: ["New York", "York City", "New York"]}


@BOTH
def test_names_of_any_length(spark, limit):
    texts = spark.createDataFrame([(1, "the Bank of New York Mellon in New York, bank of new"), (2, None), (3, "New")], "id bigint, text string")
    names = spark.createDataFrame([("Bank of New York Mellon",), ("New York",), (None,), ("...",)], "name string")
    got = {r.id: r.entities for r in extract_entities(texts, names, key="id", max_gazetteer_rows=limit).collect()}
    assert got == {1: ["Bank of New York Mellon", "New York"], 2: [], 3: []}
    short = extract_entities(texts, names, key="id", max_words=2, max_gazetteer_rows=limit).filter("id = 1").first().entities
    assert short == ["New York", "New York"]


@BOTH
def test_empty_tables(spark, texts, limit):
    nothing = spark.createDataFrame([], "token string, lemma string, name string")
    assert {r.lemmas for r in lemmatize(texts, nothing, key="id", max_lexicon_rows=limit).collect()} == {""}
    assert {len(r.entities) for r in extract_entities(texts, nothing, key="id", max_gazetteer_rows=limit).collect()} == {0}


@BOTH
def test_a_name_over_the_last_one_does_not_count(spark, limit):
    texts = spark.createDataFrame([(1, "a b c d")], "id bigint, text string")
    names = spark.createDataFrame([("a b",), ("b c",), ("c d",), ("b c d",)], "name string")
    got = extract_entities(texts, names, key="id", max_gazetteer_rows=limit).first().entities
    assert got == ["a b", "c d"]
