"""Learned endings against a brute-force count, and lemmas of unseen words."""

import zlib
from collections import Counter

import pytest

from tagloom.operators import lemma_rules
from tagloom.operators.lemma_rules import guess_lemmas, held_out_share, learn_rules, lemmatize_all

STEMS = "walk talk jump call help ask open plant start play turn work".split()
PAIRS = [(s + e, s) for s in STEMS for e in ("", "s", "ed", "ing")] + [(f"{c}ies", f"{c}y") for c in ("cit", "part", "stor", "bab")]
PAIRS += [("went", "go"), ("дома", "дом"), ("", "x"), (None, "y"), ("z", None), ("gone", "")]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(PAIRS, "token string, lemma string")


def by_hand(context, support, share, pairs=PAIRS):
    spoken = Counter()
    for token, lemma in pairs:
        if not token or not lemma:
            continue
        common = next((i for i, (a, b) in enumerate(zip(token, lemma)) if a != b), min(len(token), len(lemma)))
        cut = len(token) - common
        for size in range(max(cut, 1), min(len(token), cut + context) + 1):
            spoken[token[-size:], cut, lemma[common:]] += 1
    rules = set()
    for suffix in {k[0] for k in spoken}:
        own = sorted(((-n, cut, add) for (s, cut, add), n in spoken.items() if s == suffix))
        total = -sum(n for n, _, _ in own)
        n, cut, add = -own[0][0], own[0][1], own[0][2]
        if n >= support and n >= share * total:
            rules.add((suffix, cut, add, n, total))
    return rules


@pytest.mark.parametrize("context, support, share", [(4, 3, 0.5), (2, 1, 0.0), (1, 4, 0.9)])
def test_rules(lexicon, context, support, share):
    found = learn_rules(lexicon, context=context, min_support=support, min_share=share)
    assert {tuple(r) for r in found.select("suffix", "cut", "add", "n", "total").collect()} == by_hand(context, support, share)


def test_unseen_words_take_their_longest_ending(spark, lexicon):
    words = spark.createDataFrame([("parking",), ("parking",), ("ladies",), ("looked",), ("",), (None,), ("ing",), ("ж",)], "token string")
    found = {r["token"]: r["lemma"] for r in guess_lemmas(words, learn_rules(lexicon)).collect()}
    assert found["parking"] == "park" and found["ladies"] == "lady" and found["looked"] == "look"
    assert "ing" not in found and "ж" not in found and "" not in found  # nothing would be left, or there is no rule
    assert guess_lemmas(words, learn_rules(lexicon, min_support=999)).count() == 0


def test_texts_with_seen_and_unseen_words(spark, lexicon):
    sound = lexicon.filter("token <> ''")
    texts = spark.createDataFrame([(1, "She went PARKING, walked; gone ж"), (2, None), (3, "")], "id int, text string")
    found = {r["id"]: r["lemmas"] for r in lemmatize_all(texts, sound, key="id").collect()}
    assert found[1].endswith("go park walk") and found[2] == "" and found[3] == ""


def test_words_held_out(lexicon):
    """Counts against rules learned and applied by hand; irregular words and bare stems have no rule to go by."""
    sound = [(t, m) for t, m in PAIRS if t and m]
    late = [(t, m) for t, m in sound if zlib.crc32(t.encode()) % 5 == 0]
    changes = {r[0]: r[1:3] for r in by_hand(4, 3, 0.5, [p for p in sound if p not in late])}
    guesses = {}
    for token, _ in late:
        size = max((n for n in range(1, len(token) + 1) if token[-n:] in changes), default=0)
        cut, add = changes[token[-size:]] if size else (len(token), "")
        guesses[token] = token[: len(token) - cut] + add
    row = held_out_share(lexicon).first()
    assert (row["pairs"], row["guessed"]) == (len(late), sum(g != "" for g in guesses.values()))
    assert row["right"] == sum(guesses[t] == m for t, m in late) > 0


def test_guesses_beside_the_texts_equal_those_of_a_join(spark, monkeypatch):
    """A small lexicon and its rules need no table of all words, and give what such a table gives."""
    pairs = [(f"{w}s", w) for w in ("cat", "dog", "bird", "tree", "song")] + [("nothing", ""), ("none", None), ("is", "be")]
    lexicon = spark.createDataFrame(pairs, "token string, lemma string")
    texts = [(1, "Cats and horses, nothing none"), (2, ""), (3, None), (4, "s is WOLVES birds s's")]
    rows = spark.createDataFrame(texts, "id bigint, text string")
    joined = {r["id"]: r["lemmas"] for r in lemmatize_all(rows, lexicon, key="id", max_lexicon_rows=1).collect()}

    def refused(*_):
        raise AssertionError("the words of all texts were listed")

    monkeypatch.setattr(lemma_rules, "guess_lemmas", refused)
    near = {r["id"]: r["lemmas"] for r in lemmatize_all(rows, lexicon, key="id").collect()}
    assert near == joined and near[1] == "cat horse" and near[2] == near[3] == ""
