"""Queries that SQL can't express, against brute force over the smallest tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_conversations import brute as repairs
from test_decontaminate import brute as leaks
from test_pii import by_patterns
from test_simhash import fingerprint, roots
from test_variants import brute as spelled

import corpus_pipeline
from tagloom.llm import pieces, pii, toxicity
from tagloom.llm.batches import plain
from tagloom.llm.catalog import PIECE_MODEL, QUERIES
from tagloom.llm.conversations import Costs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")


def read(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r["text"] or "" for r in read("documents")}


def answer(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


def test_archives(spark):
    pages = read("pages")
    bodies = {p["page_id"]: (p["html"] or "").encode() for p in pages}
    first = {}
    for page in sorted(bodies):
        first.setdefault(bodies[page], page)
    want = {
        p: (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first[b] == p else "revisit", None if first[b] == p else first[b])
        for p, b in bodies.items()
    }
    got = answer(spark, "op3_warc")
    assert len(got) == len(pages)
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == want


def test_near_duplicates(spark, docs):
    prints = {k: fingerprint(t) for k, t in docs.items()}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = roots(prints, linked)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in answer(spark, "op5_simhash")}
    assert got == {k: (f"{prints[k]:016x}", groups[k]) for k in docs}


def test_encoding(spark, docs):
    model = pieces.PieceModel(Path(PIECE_MODEL).read_bytes())
    got = {r["doc_id"]: r for r in answer(spark, "op2_sentencepiece")}
    assert got.keys() == docs.keys() and all(r["lossless"] for r in got.values())
    for key, text in list(docs.items())[:40]:
        variant = pieces.variant_key(str(key), pieces.SEED, pieces.VARIANTS)
        units = re.findall(" +[^ ]*|[^ ]+", " " + text) if text else []
        one_by_one = [i for u in units for i in model.segment(u.replace(" ", pieces.BLANK), variant, pieces.DROPOUT)]
        assert got[key]["n_pieces"] == len(one_by_one)


def test_language_model(spark, docs):
    def tokens(text):
        return [*re.findall("[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)})), ""]

    late = {k for k in docs if zlib.crc32(str(k).encode()) % 7 == 2}
    count = Counter(w for k, t in docs.items() if k not in late for w in tokens(t))
    total, words = sum(count.values()), len(count)
    gained = 0.0
    for r in answer(spark, "op7_class_lm"):
        stream = tokens(docs[r["doc_id"]])
        base = sum(math.log10((count[w] + 1) / (total + words + 1)) for w in stream)
        assert r["held_out"] == (r["doc_id"] in late)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(stream), sum(count[w] > 0 for w in stream), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isfinite(r["score"])
        gained += r["held_out"] * (r["score"] - r["base_score"])
    assert gained > 0


def test_personal_data(spark, docs):
    for r in answer(spark, "op8_pii"):
        base = by_patterns(docs[r["doc_id"]])
        written = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        assert set(written) <= set(r["spans"].split(",")) | {""}


def test_rollup(spark):
    from tokenizers import Tokenizer

    import tagloom.llm.token_rollup as rollup

    plain_counts = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    plain_counts.encode_special_tokens = True
    many = rollup._encoding(Path("/opt/tokenizers/byte_bpe_multi_50k.tiktoken").read_bytes())
    low = {r["doc_id"] for r in read("labels") if r["quality"] == 0}
    want = {}

    def add(row, name, sign, tokens):
        sums = want.setdefault((row["source"], row["lang"], name), [0, 0, 0])
        for i, v in enumerate((1, tokens, row["n_chars"])):
            sums[i] += sign * v

    for row in read("documents"):
        n = len(plain_counts.encode(row["text"] or "", add_special_tokens=False).ids)
        add(row, "byte_bpe_50k", 1, n)
        if row["doc_id"] in low:
            add(row, "byte_bpe_50k", -1, n)
        elif row["lang"] not in (None, "en"):
            add(row, "byte_bpe_50k", -1, n)
            add(row, "byte_bpe_multi_50k", 1, len(many.encode_ordinary(row["text"] or "")))
    got = {(r["source"], r["lang"], r["tokenizer"]): [r["docs"], r["tokens"], r["chars"]] for r in answer(spark, "op9_token_rollup")}
    assert got == want


def test_toxicity(spark):
    """Held-out accuracy; texts far from any term score low."""
    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("tables are not here")
    got = {r["doc_id"]: r.asDict() for r in QUERIES["op6_toxicity"](spark, folder).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    assert len(got) == pq.read_table(f"{folder}/documents.parquet").num_rows
    for key, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    late = [(got[k]["predicted"], t) for k, t in truth.items() if got[k]["held_out"]]
    assert sum(p == t for p, t in late) / len(late) > 0.93
    clean = [p for p, t in late if t == 0]
    assert sum(clean) / len(clean) < 0.02


def test_pipeline(spark, docs):
    """Every stage by brute force on what the one before kept."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(rows, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {}
    for key, text in docs.items():
        x = toxicity.features(model, plain(pa.array([text])))[0]
        if 1 / (1 + math.exp(-(sum(a * b for a, b in zip(x, model.coefficients, strict=True)) + model.intercept))) < 0.5:
            kept[key] = text
    groups = {}
    for key, text in kept.items():
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text), []).append((-len(text), key))
    kept = {k: kept[k] for k in (min(g)[1] for g in groups.values())}
    prints = {k: fingerprint(t) for k, t in kept.items()}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    kept = {k: kept[k] for k in set(roots(prints, linked).values())}
    items = [(str(r["item_id"]), r["text"]) for r in read("benchmark")]
    hit = {r[0] for r in leaks(list(kept.items()), items, 10) if r[2]}
    kept = {k: t for k, t in kept.items() if k not in hit}
    got = {r["doc_id"]: r["pieces"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == kept.keys()
    known = pieces.bytes_of_pieces(Path(PIECE_MODEL).read_bytes())
    assert all(pieces.decode_slice(known, pa.array([got[k]], pa.list_(pa.int32()))) == [t] for k, t in kept.items())


def test_spelling_variants(spark, docs):
    count = Counter()
    for key, text in docs.items():
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 7
    got = sorted(tuple(r.values()) for r in answer(spark, "op12_spelling_variants"))
    assert got == spelled({w: n for w, n in count.items() if n >= 2})


def test_conversations(spark):
    rows, every = [], set()
    for r in read("conversations"):
        every.add(r["conv_id"])
        role, text = r["role"], r["text"]
        h = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(h, text)
        rows += [(r["conv_id"], r["turn"], "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    want = repairs(rows, Costs())
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r["conv_id"]: tuple(r.values())[1:] for r in answer(spark, "op13_conversation_repair")}
    assert got == {k: want.get(k, none) for k in every}
