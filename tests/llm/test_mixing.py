import hashlib
import math
import random
import re

import pytest

from tagloom.llm import mixing

DOCS = "doc_id bigint, source string, text string"


def budgets(sizes, weights, share, most):
    """Targets by dealing out again and again, a source at a time."""
    wanted, open_, given = share * sum(sizes.values()), {s for s in sizes if weights.get(s, 0) > 0}, {}
    while open_:
        level = (wanted - sum(given.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= weights[s] * level}
        if not full:
            return {**{s: weights[s] * level for s in open_}, **given}
        given.update({s: most * sizes[s] for s in full})
        open_ -= full
    return given


def brute(docs, weights, ratings, share=1.5, most=2.0):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, _, t in docs]
    total = {}
    for (_, s, _), n in zip(docs, size, strict=True):
        total[s] = total.get(s, 0) + n
    target = budgets(total, weights, share, most)
    taken = [0] * len(docs)
    for s in total:
        rows = [i for i, d in enumerate(docs) if d[1] == s]
        epochs = math.floor(target.get(s, 0) / total[s]) if total[s] else 0
        left = math.floor(target.get(s, 0) + 0.5) - epochs * total[s]

        def draw(i):
            key = docs[i][0]
            name = str(key) if key is not None else "none" if docs[i][2] is None else "text:" + docs[i][2]
            u = (int(hashlib.md5(f"{mixing.SEED}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / ratings.get(key, 1.0), key is None, key or 0, size[i]

        for i in sorted(rows, key=draw):
            part = max(0, min(size[i], left))
            left -= size[i]
            taken[i] = epochs * size[i] + part
    return sorted((d[0] is None, d[0] or 0, str(d[1]), n, t) for d, n, t in zip(docs, size, taken, strict=True))


def mixed(spark, docs, weights, ratings, **options):
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    rated = spark.createDataFrame(list(ratings.items()), "doc_id bigint, quality double") if ratings else None
    return mixing.mix(spark.createDataFrame(docs, DOCS), given, ratings=rated, **options)


def rows_of(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, str(r["source"]), r["size"], r["taken"]) for r in df.collect())


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "é"]), " ".join(["w"] * rng.choice([0, 1, 2, 5, 40]))) for i in range(400)]
    rows += [(None, "b", None), (None, "b", "x y"), (5, "a", "x  y\n z"), (7, "d", ""), (500, "e", "w " * 3000)]
    return rows


@pytest.mark.parametrize("bucket_rows", [1, 7, 65536])
def test_against_brute_force(spark, docs, bucket_rows):
    """The same documents at any size of buckets."""
    weights = {"a": 3.0, "b": 1.0, "c": 2.0, None: 1.0, "é": 0.0, "e": 0.5}
    ratings = {i: [0.5, 2.0, 40.0][i % 3] for i in range(0, 400, 2)}
    assert rows_of(mixed(spark, docs, weights, ratings, bucket_rows=bucket_rows)) == brute(docs, weights, ratings)


def test_targets_are_met(spark, docs):
    weights = {s: 1.0 for s in ("a", "b", "c", None, "é", "e", "d")}
    rows = mixed(spark, docs, weights, {}).collect()
    for source in weights:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        assert own[0]["target"] <= 2 * own[0]["source_size"]
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert math.isclose(sum({r["source"]: r["target"] for r in rows}.values()), 1.5 * sum(r["size"] for r in rows))


def test_good_documents_come_first(spark):
    docs = [(i, "a", "one two three") for i in range(2000)]
    ratings = {i: 8.0 for i in range(1000)}
    rows = mixed(spark, docs, {"a": 1.0}, ratings, share=0.3).collect()
    good = sum(r["taken"] for r in rows if r["doc_id"] < 1000)
    assert good > 0.8 * sum(r["taken"] for r in rows)


def test_repeated_rows_and_odd_ratings(spark):
    """A third of all rows is one row; undefined and extreme ratings are held within bounds."""
    docs = [(1, "a", "x y")] * 50 + [(i, "a", "x y") for i in range(2, 100)]
    ratings = {2: math.nan, 3: math.inf, 4: -1.0, 5: 0.0}
    rows = mixed(spark, docs, {"a": 1.0}, ratings, share=0.5, bucket_rows=8).collect()
    assert len(rows) == len(docs) and sum(r["taken"] for r in rows) == 148
    assert [r["taken"] for r in rows if r["doc_id"] == 3] == [2] and [r["taken"] for r in rows if r["doc_id"] in (4, 5)] == [0, 0]


def test_empty_tables_and_clashing_names(spark):
    assert mixed(spark, [], {"a": 1.0}, {}).collect() == []
    assert [r["taken"] for r in mixed(spark, [(1, "a", "x")], {}, {}).collect()] == [0]
    docs = spark.createDataFrame([(1, "a", "x y", 9, 9, 9)], DOCS + ", size int, taken int, _key int")
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    found = mixing.mix(docs, weights).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(2, 3.0, 3)]


def test_cyclic_weights(spark):
    docs = spark.createDataFrame([("b",), ("a",), (None,), ("é",), ("a",)], "source string")
    assert {r["source"]: r["weight"] for r in mixing.cyclic_weights(docs, (3.0, 1.0, 2.0)).collect()} == {"a": 3, "b": 1, "é": 2, None: 3}


def test_copies(spark):
    docs = spark.createDataFrame([(1, "a", " p q  r"), (2, "b", "s"), (3, "b", "")], DOCS)
    taken = spark.createDataFrame([(1, 3, 5), (2, 1, 0), (3, 0, 0)], "doc_id bigint, size bigint, taken bigint")
    got = sorted((r["doc_id"], r["epoch"], r["text"]) for r in mixing.copies(docs, taken).collect())
    assert got == [(1, 0, " p q  r"), (1, 1, "p q")]
    with pytest.raises(ValueError, match="unique"):
        mixing.copies(docs, taken.union(taken))
