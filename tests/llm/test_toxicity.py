"""The automaton against edit distances, and scores on held-out texts."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import toxicity
from tagloom.llm.batches import plain


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


TERMS = ["fool", "cretin", "blockhead", "crétin", "blockheads", "foolish"]


def test_automaton_finds_all_words_within_the_edits():
    rng = random.Random(4)
    automaton = toxicity.LexiconAutomaton(TERMS, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    words = {""} | set(TERMS)
    for _ in range(1500):
        w = list(rng.choice(TERMS))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "x", "é", "o", "🫠"])
        words.add("".join(w))
    words = sorted(words)
    found, edits = automaton.match(pa.array(words))
    for word, t, e in zip(words, found.tolist(), edits.tolist(), strict=True):
        near = [(distance(word, x), -automaton.weights[i], i) for i, x in enumerate(TERMS) if distance(word, x) <= toxicity.allowed_edits(len(x))]
        assert (t, e) == ((min(near)[2], min(near)[0]) if near else (-1, 0)), word


def test_a_small_table_gives_the_same_answers():
    rng = random.Random(8)
    scripts = ["abcdefghijklm", "абвгдежзийклмн", "αβγδεζηθικλμν"]
    terms = sorted({"".join(rng.choices(rng.choice(scripts), k=rng.randrange(4, 14))) for _ in range(200)})
    words = []
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(rng.choice(scripts))
        words.append("".join(w))
    large = toxicity.LexiconAutomaton(terms, [1.0] * len(terms))
    small = toxicity.LexiconAutomaton(terms, [1.0] * len(terms), table_bytes=1 << 14)
    for a, b in zip(large.match(pa.array(words)), small.match(pa.array(words)), strict=True):
        assert a.tolist() == b.tolist()
    assert len(small.states) < small.most_states + small.block < len(large.states)


def test_long_words_and_scripts_without_blanks_become_terms(spark):
    long, longer = "q" + "uagmire" * 5 + "s", "z" * 70_000
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = f"plain words number {i} 我们今天去看书了 {'y' * (60 + i)}"
        rows.append((i, text + (f" {long} {longer} 你是混蛋吗" if bad else "")))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert {long, "混蛋"} <= set(model.terms)
    assert all(len(t) <= toxicity.MAX_LETTERS + 1 for t in model.terms)
    asked = [long, long.replace("m", "n", 1), longer, longer + "z", "混蛋", "我们", "plain"]
    term, edits = model.match(pa.array(asked))
    assert [t >= 0 for t in term.tolist()] == [True, True, True, False, True, False, False]
    assert edits.tolist()[:2] == [0, 1]
    probe = spark.createDataFrame([(1, "那个混蛋来了"), (2, "我们来了"), (3, longer), (4, None)], docs.schema)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}
    assert scores[1] > scores[2] and scores[3] > scores[4]  # one hit each; texts of the training hold many


def test_empty_lexicon():
    assert toxicity.LexiconAutomaton([], []).match(pa.array(["a", ""]))[0].tolist() == [-1, -1]


def test_contexts_tell_quotation_from_abuse():
    found = {"cretin": (0, 0)}
    assert toxicity.contexts("You cretin!", found) == [(0, 0, False, True)]
    assert toxicity.contexts('the label “cretin” was common', found) == [(0, 0, True, False)]
    assert toxicity.contexts("they said cretin once", found) == [(0, 0, True, False)]
    assert toxicity.contexts("a plain CRETIN here", found) == [(0, 0, False, False)]
    assert toxicity.contexts("cretins acretin écretin cretin_ a“cretin ", found) == [(0, 0, False, False)]
    assert len(toxicity.contexts("cretin cretin,cretin.«Cretin»", found)) == 4


def test_every_hit_of_the_words_has_a_context():
    rng = random.Random(2)
    automaton = toxicity.LexiconAutomaton(TERMS, [1.0] * len(TERMS))
    for _ in range(300):
        text = "".join(rng.choices(["fool", "Cretin", " ", ",", "“", "”", "é", "x", "foolish", "_", "\n"], k=rng.randrange(30)))
        words, _ = toxicity.lexical_words(plain(pa.array([text])))
        term, edits = automaton.match(words)
        hits = [(w, t, e) for w, t, e in zip(words.to_pylist(), term.tolist(), edits.tolist(), strict=True) if t >= 0]
        read = toxicity.contexts(text, {w: (t, e) for w, t, e in hits})
        assert sorted((t, e) for t, e, _, _ in read) == sorted((t, e) for _, t, e in hits), text


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    words = [f"wort{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        text = rng.choices(words, k=rng.randrange(20, 60))
        for _ in range(rng.randrange(2, 5) if bad else 0):
            term = rng.choice(["cretin", "blockhead", "dunce"])
            if i % 12 == 0 and i > 500:
                term = term[:2] + "x" + term[3:]
            text.insert(rng.randrange(len(text)), term)
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_texts(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels.filter("doc_id < 500"))
    assert {"cretin", "blockhead", "dunce"} <= set(model.terms)
    scored = toxicity.score(docs, model).join(labels, "doc_id").filter("doc_id >= 500")
    right = scored.select(F.avg((F.col("score").between(0.5, 1) == (F.col("toxic") == 1)).cast("int"))).first()[0]
    assert right > 0.97
    assert scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_rows_without_labels_texts_or_keys(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "!!! ...", 3), (2, "x" * 300_000, 4), (3, "cretin " * 20_000, 5)], "doc_id bigint, text string, SCORE int")
    out = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert len(out) == 4 and all(0 <= s <= 1 for s in out.values())
    assert out[3] > 0.5 > out[1]
    empty = labels.limit(0)
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(docs, empty)).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(docs, labels.withColumn("toxic", F.lit(1)))).collect()} == {1.0}
    doubled = labels.unionByName(labels.withColumn("toxic", F.lit(None).cast("int"))).unionByName(labels)
    assert toxicity.fit(docs, doubled).terms == model.terms
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_features_do_not_depend_on_slices(corpus):
    model = toxicity.ToxicityModel(["cretin"], [1.0])
    texts = plain(pa.array(["a cretin", "", None, "cretin cretan"]))
    whole = toxicity.features(model, texts)
    assert (whole == [toxicity.features(model, texts.slice(i, 1))[0] for i in range(4)]).all()


def test_short_words_become_terms_and_many_terms_all_count(spark):
    rng = random.Random(5)
    clean = [f"wort{i}" for i in range(300)]
    rude = ["zut", "笨蛋", "scum"]
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, " ".join([*rng.choices(clean, k=rng.randrange(2, 30)), *([rng.choice(rude)] if bad else [])])))
        labels.append((i, int(bad)))
    rows += [(1000, "wort1 zut wort2 wort3 wort4"), (1001, "wort1 笨蛋 wort2 wort3 wort4"), (1002, "wort1 scvm wort2 wort3 wort4"), (1003, "wort1 wort2 wort3 wort4")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert set(model.terms) == set(rude)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df.filter("doc_id >= 1000"), model).collect()}
    assert min(got[1000], got[1001], got[1002]) > 0.5 > got[1003]


def test_lexicon_larger_than_one_automaton(monkeypatch):
    rng = random.Random(8)
    weights = [1.0, 2.0, 3.0, 4.0, 5.0, 4.0]
    words = sorted({"".join(rng.choices("folcretinbkhads", k=rng.randrange(1, 8))) for _ in range(300)} | {t[:-1] for t in TERMS} | set(TERMS))
    want = [x.tolist() for x in toxicity.LexiconAutomaton(TERMS, weights).match(pa.array(words))]
    for together in (1, 2, 4):
        monkeypatch.setattr(toxicity, "TOGETHER", together)
        got = [x.tolist() for x in toxicity.ToxicityModel(TERMS, weights).match(pa.array(words))]
        assert got == want
    assert any(t >= 4 for t in want[0])
