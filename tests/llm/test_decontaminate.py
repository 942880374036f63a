"""Windows of benchmark items against a search word by word."""

import random
import re

import pyarrow as pa
import pytest

from tagloom.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width):
    windows = []
    for item, text in items:
        w = words(text)
        size = min(width, len(w))
        windows += [(item or "", tuple(w[i : i + size])) for i in range(len(w) - size + 1) if size]
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
        out.append((key, len(w), len(hit), sorted(found), sorted(hit)))
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id string, text string")


def scanned(spark, docs, items, **options):
    d, b = tables(spark, docs, items)
    rows = decontaminate.scan(d, b, **options).select("doc_id", "n_words", "n_hit", "items", "hit_words").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "Dog", "cat", "0", "x1"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(30)] + [(None, None), (40, ""), (40, "..."), (41, "a b " * 5000)]
    items = [(str(i), text(rng.choice([0, 1, 3, 4, 5, 9]))) for i in range(8)] + [(None, "é dog"), ("7", "cat cat"), ("10", None)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_bytes", [1 << 20, 120])
def test_against_brute_force(spark, seed, max_bytes):
    docs, items = made(seed)
    assert scanned(spark, docs, items, width=4, max_bytes=max_bytes) == brute(docs, items, 4)


def test_windows_do_not_cross_texts(spark):
    out = scanned(spark, [(1, "one two"), (2, "three four")], [("i", "one two three four")], width=4)
    assert [r[2] for r in out] == [0, 0]


def test_removal_of_documents_and_spans(spark):
    d, b = tables(spark, [(1, "keep, One-two THREE! end"), (2, "clean"), (3, None)], [("i", "one two three")])
    assert sorted(r[0] for r in decontaminate.decontaminate(d, b).collect()) == [2, 3]
    spans = {r[0]: r[1] for r in decontaminate.decontaminate(d, b, remove="spans").collect()}
    assert spans == {1: "keep,  ! end", 2: "clean", 3: None}


def test_empty_tables_and_clashing_names(spark):
    d, b = tables(spark, [(1, "a")], [("i", "a")])
    assert decontaminate.scan(d.limit(0), b).count() == 0
    assert decontaminate.scan(d, b.limit(0)).collect()[0]["n_hit"] == 0
    clash = d.selectExpr("*", "'x' AS items", "1 AS N_HIT")
    assert decontaminate.scan(clash, b).collect()[0]["items"] == ["i"]


def test_repeated_and_large_items_keep_to_the_bound(spark):
    """Equal items are one, however often they stand there; blocks of several items take no more than the bound."""
    words = " ".join(f"w{i}" for i in range(200))
    items = [("r", words)] * 50 + [(str(i), f"{words} x{i}") for i in range(30)]
    _, b = tables(spark, [(1, "a")], items)
    one = 2 * 200 * (decontaminate.WORD_BYTES + 4)
    blocks = decontaminate._blocks(b, "item_id", "text", 4 * one)
    sizes = [block.count() for block in blocks]
    assert sum(sizes) == 31 and len(sizes) > 2 and max(sizes) < 20
    single = decontaminate._blocks(b, "item_id", "text", 10)
    assert all(block.count() == 1 for block in single) and len(single) == 31
    docs = [(1, "before " + words + " x7 after"), (2, words[:40])]
    assert scanned(spark, docs, items, max_bytes=4 * one) == scanned(spark, docs, items) == brute(docs, items, 10)


def test_the_set_takes_what_the_bound_counts():
    import pickle

    texts = [" ".join(f"word{(i * j) % 5000}" for j in range(3000)) for i in range(1, 40)]
    known = decontaminate.window_set(pa.table({"id": [str(i) for i in range(len(texts))], "text": texts}))
    counted = sum(len(t.encode()) + decontaminate.WORD_BYTES * 3000 + 32 for t in texts)
    assert len(pickle.dumps(known)) <= counted


def test_very_long_text(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = [(1, "x " * 1_500_000 + item + " y" * 500_000)]
    assert [r[1:3] for r in scanned(spark, docs, [("i", item)])] == [(2_000_012, 12)]
