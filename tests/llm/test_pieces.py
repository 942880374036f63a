"""Merge-dropout: the model's own pieces without it, lossless and repeatable with it."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import pieces
from tagloom.llm.batches import plain

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not Path(MODEL).exists(), reason="tokenizers are not here")

TEXTS = [
    "Plain words, twice: plain words.", "", " ", "   ", " lead", "trail ", "two  blanks   three", "tab\tand\nline\r\n", "é ß 漢字 ﬁ Ａ 🫠 \x00 \x85\xa0x",
    "a" * 3000, "<s> </s> <unk> <0x41>", "Zusammengesetztes Wörterbuch", "x" * 50 + " " + "1234567890" * 30,
]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(Path(MODEL).read_bytes())


def ids(model, text, dropout, key=5):
    values, sizes = pieces.encode_slice(model, plain(pa.array([text, "between", text])), [key, key, key], dropout)
    a, b = sizes[0], sizes[0] + sizes[1]
    assert values[:a].tolist() == values[b:].tolist()
    return values[:a].tolist()


def test_without_dropout_it_is_the_model(model):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in TEXTS:
        assert ids(model, text, 0.0) == own.encode(text), text
    docs = "/root/testdata/sf0.001/documents.parquet"
    if Path(docs).exists():
        import pyarrow.parquet as pq

        texts = pq.read_table(docs)["text"].to_pylist()[:60]
        values, sizes = pieces.encode_slice(model, plain(pa.array(texts)), [0] * len(texts), 0.0)
        assert values.tolist() == [i for t in own.encode(texts) for i in t]
        assert sizes.tolist() == [len(t) for t in own.encode(texts)]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_lossless_and_repeatable(model, dropout):
    for text in [*TEXTS, "▁", "a▁b ▁ c", " ▁▁ "]:
        first = ids(model, text, dropout)
        assert first == ids(model, text, dropout)
        assert pieces.decode_slice(pieces.bytes_of_pieces(Path(MODEL).read_bytes()), pa.array([first], pa.list_(pa.int32()))) == [text]


def test_dropout_varies_with_seed_and_variant(model):
    text = "international communication understanding responsibility " * 3
    plain_ids = ids(model, text, 0.0)
    seen = {tuple(ids(model, text, 0.3, key)) for key in range(8)}
    assert len(seen) == 8 and tuple(plain_ids) not in seen
    assert len(ids(model, text, 1.0)) == len(text) + 1  # every character, and the blank put in front


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6])
def test_units_together_are_units_one_by_one(model, dropout):
    import random

    rng = random.Random(1)
    units = ["▁" + "".join(rng.choices("thentioségaßЖя漢▁.,0A", k=rng.randrange(45))) for _ in range(3000)] + ["▁", "▁▁▁▁", "a", "▁🫠x", "▁ⅷ"]
    keys = np.array([rng.randrange(3) for _ in units])
    values, lengths = pieces.segment_all(model, units, keys, dropout)
    ends = np.cumsum(lengths)
    for u, k, a, b in zip(units, keys.tolist(), ends - lengths, ends, strict=True):
        assert values[a:b].tolist() == model.segment(u, k, dropout), u


def test_share_of_skipped_merges(model):
    """Of merges that stand alone, about the asked share is skipped."""
    skipped = sum(len(model.segment("▁a", key, 0.2)) == 2 for key in range(4000))
    assert 0.17 < skipped / 4000 < 0.23


def test_tables(spark):
    df = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (1, "▁x  y", 3), (2, "", 4)], "doc_id bigint, text string, PIECES int")
    out = pieces.encode(df, MODEL)
    assert out.columns == ["doc_id", "text", "pieces"]
    back = pieces.decode(out, MODEL).collect()
    assert [r["decoded"] for r in back] == [r["text"] or "" for r in back]
    one = {(r["doc_id"], r["text"]): r["pieces"] for r in out.collect()}
    two = {(r["doc_id"], r["text"]): r["pieces"] for r in pieces.encode(df.repartition(4), MODEL).collect()}
    assert one == two
    assert pieces.encode(df.limit(0), MODEL).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(df, MODEL, dropout=2)
