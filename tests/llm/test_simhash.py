"""Fingerprints and groups against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tagloom.llm import simhash
from tagloom.llm.batches import plain
from tagloom.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


TEXTS = ["", None, "  ", "one", "One two", "a b c", "a  b\tc", "é ß 漢 字 x", "same words " * 3000, "\x1c a\x85b c d e"]


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices(["a", "bb", "Ccc", "é"], k=rng.randrange(40))) for _ in range(50)]
    want = [fingerprint(t) for t in texts]
    assert simhash.fingerprints(plain(pa.array(texts, pa.string()))).tolist() == want
    monkeypatch.setattr(simhash, "_PIECE", 7)
    assert simhash.fingerprints(plain(pa.array(texts, pa.string()))).tolist() == want


@pytest.mark.parametrize("parts,tile", [(1, 64), (2, 5), (2, 4096), (4, 3), (8, 100)])
def test_links_connect_what_all_pairs_connect(spark, parts, tile):
    rng = random.Random(parts)
    seeds = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for s in seeds for _ in range(12)}
    signed = {int(np.uint64(p).astype(np.int64)) for p in prints}
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {(r["a"], r["b"]) for r in simhash.links(df, 3, parts, tile).collect()}
    bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    every = [(a, b) for a in signed for b in signed if a < b and bits(a, b) <= 3]
    assert roots(signed, found) == roots(signed, every)


def test_large_groups_give_few_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, dtype=np.uint64)
    near = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)))
    a, b = simhash._forest(near, near, 3)
    assert len(a) < len(near)
    assert len(set(roots(near.tolist(), list(zip(a.tolist(), b.tolist(), strict=True))).values())) == 1


def test_groups_of_texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for g in range(15):
        body = rng.choices(words, k=400)
        for _ in range(rng.randrange(1, 6)):
            changed = list(body)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(400)] = "new"
            docs.append(" ".join(changed))
    docs += TEXTS
    rows = [(i * 7 % 97, t) for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_groups(df).collect()}
    prints = {k: fingerprint(t) for k, t in rows}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {k: v[1] for k, v in got.items()} == roots(prints, linked)
    assert {k: v[0] & (1 << 64) - 1 for k, v in got.items()} == prints
    kept = sorted(r["doc_id"] for r in simhash.keep_one(df).collect())
    assert kept == sorted(set(roots(prints, linked).values()))


def test_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (None, "zz yy xx ww")], "doc_id bigint, text string")
    out = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_groups(df).collect()), key=repr)
    assert out == [(3, 3), (None, 3), (None, None)]
    assert sorted((tuple(r) for r in simhash.keep_one(df).collect()), key=repr) == [(3, "a b"), (None, "zz yy xx ww")]
    assert simhash.near_groups(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_rows_stay_or_go_by_text_where_keys_repeat(spark):
    """(5, first) is the only row of its group; (5, second) goes for (3, second)."""
    first, second = "p q r s t u v", "1 2 3 4 5 6 7 8"
    rows = [(5, first, 1), (5, second, 2), (3, second + " ", 3), (None, second, 4), (8, "own own own", 5), (8, "own own own", 6), (None, None, 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, other int").repartition(3)
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(df).collect())
    assert kept == [(0, ""), (3, second + " "), (5, first), (8, "own own own")]
    assert simhash.keep_one(df).columns == df.columns


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    n = 60
    links = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(0, i) for i in range(1, n)] + [(i, -1) for i in range(50, n)],
        "random": [(rng.randrange(100), rng.randrange(100)) for _ in range(50)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in components(df).collect()} == roots(nodes, [x for x in links if x[0] != x[1]])
