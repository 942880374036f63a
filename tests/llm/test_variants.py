import random
from collections import Counter

import numpy as np
import pytest

from tagloom.llm import variants


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocabulary, ratio=10):
    near = {w: [x for x in vocabulary if one_apart(w, x)] for w in vocabulary}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-vocabulary[x], x), default=None)
        if best is not None and vocabulary[best] >= ratio * vocabulary[w]:
            form[w] = best
    rows = []
    for w, n in vocabulary.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), vocabulary[form[w]] if w in form else None))
    return sorted(rows)


def found(spark, vocabulary, **options):
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    got = variants.variants(words, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def dense():
    """Words of few letters, so that most have near ones, some beyond the basic plane."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(700)} | {"😀a😀aaa", "😀b😀aaa", "a😀aaa"}
    return {w: rng.choice([1, 1, 2, 3, 30, 400, 5000]) for w in words}


@pytest.mark.parametrize("tile", [variants.TILE, 3])
def test_against_brute_force(spark, dense, tile):
    """The same rows whether groups fit a list or are cut into tiles."""
    assert found(spark, dense, tile=tile) == brute(dense)


def test_only_long_words(spark, dense):
    long = {w: n for w, n in dense.items() if len(w) >= 7}
    assert found(spark, long, min_length=7) == brute(long)


def test_small_steps(spark, dense, monkeypatch):
    monkeypatch.setattr(variants, "QUERIES", 5)
    words = sorted(w for w in dense if len(w) in (7, 8) and w.startswith("abb"))
    chars = variants._code_points(words, 8)
    q, w = variants.scan(chars, chars, np.zeros(len(words), np.int64), 7, 3)
    assert sorted(zip(q.tolist(), w.tolist(), strict=True)) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b)]


def test_chains_end_at_the_root(spark):
    chain = {"aaaaaaa": 10**6, "aaaaaab": 10**5, "aaaaabb": 10**4, "aaaabbb": 10**3, "aaabbbb": 100, "aabbbbb": 10, "abbbbbb": 1}
    rows = {r[0]: r[2] for r in found(spark, chain)}
    assert set(rows.values()) == {"aaaaaaa"}


def test_ties_go_to_the_smaller_word(spark):
    rows = found(spark, {"xbcdefg": 50, "abcdefx": 50, "abcdefg": 2, "abcxefg": 50})
    assert [r[1] for r in rows if r[0] == "abcdefg"] == ["abcdefx"]


def test_very_long_and_odd_words(spark):
    long = "ab" * 3000
    vocabulary = {long: 100, long[:2500] + long[2501:]: 2, long + "c": 3, "": 4, "b": 50, "c": 1}
    want = [r for r in brute(vocabulary) if r[0]]
    got = [r for r in found(spark, vocabulary) if r[0]]
    assert [r[:4] for r in got if len(r[0]) > 1] == [r[:4] for r in want if len(r[0]) > 1]
    assert [r for r in got if r[0] == "c"] == [("c", "b", "b", 1, 1, 50)]
    assert found(spark, {}) == []
    with pytest.raises(ValueError, match="ratio"):
        found(spark, {"a": 1}, ratio=1)


def test_vocabulary_and_runs(spark):
    texts = [(None,), ("",), ("Straße STRASSE strasse x1strasse Ärztinnen ärztinnen",), ("a" * 200_000 + " strasse",)]
    runs = spark.createDataFrame(texts, "text string").selectExpr("text")
    words = runs.select(variants.F.explode(variants.long_runs(runs.text)).alias("word"))
    want = Counter(["strasse"] * 4 + ["Ärztinnen", "ärztinnen", "a" * 200_000])
    assert Counter(r["word"] for r in words.collect()) == want
    assert [tuple(r) for r in variants.vocabulary(words).collect()] == [("strasse", 4)]


def test_words_are_replaced_by_their_roots(spark):
    table = variants.variants(spark.createDataFrame([("strasse", 40), ("strase", 2)], "word string, n bigint"))
    docs = spark.createDataFrame([(1, "strase"), (2, "other"), (3, None)], "id int, token string")
    got = variants.normalised(docs, table, "token")
    assert sorted(got.collect()) == [(1, "strasse"), (2, "other"), (3, None)] and got.columns == ["id", "token"]
