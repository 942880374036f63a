"""Benchmark decontamination: find the windows of test items in training texts.

The windows of the items become a hash set that is broadcast: every run of ``width`` consecutive words of an item, or
the whole item where it is shorter. A text is split into words, words turn into the set's word numbers, and rolling
codes of the numbers are looked up in the set. A hit counts only after all its words were compared.

The set is broadcast while it takes up to ``max_bytes``, counted by the words of the items: each begins a window, which
takes a code, a place and an owner. More items are cut into blocks of that size, and the texts pass the blocks one after
another, so the result doesn't depend on the bound. Equal items are counted once; one item larger than the bound is a
block of its own.

Null texts have no words. An item without words has no window. Items are counted by distinct id, a null id counts as
the empty one. Empty tables on either side give empty results or no hits. A very long text is scanned whole, in memory
that grows with its words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import ALNUM, append_columns, plain, split_words
from tagloom.operators.sizing import staged

WIDTH = 10
MAX_SET_BYTES = 128 << 20
#: What a word of an item takes in the set, besides its own bytes: number, code, place, first item, item.
WORD_BYTES = 4 + 8 + 4 + 4 + 4
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
]


@dataclass
class WindowsOfLength:
    width: int
    codes: np.ndarray  # sorted, one per distinct window
    starts: np.ndarray  # place of its first word among the numbers of all items' words
    first_item: np.ndarray  # items of window i: item[first_item[i] : first_item[i + 1]]
    item: np.ndarray


@dataclass
class WindowSet:
    vocabulary: pa.Array
    numbers: np.ndarray  # words of all items, one after another
    ids: list[str]  # sorted
    lengths: list[WindowsOfLength]


def _codes(words: np.ndarray, starts: np.ndarray, width: int, factor: np.uint64) -> np.ndarray:
    code = np.zeros(len(starts), np.uint64)
    for k in range(width):
        code = code * factor + words[starts + k].astype(np.uint64) + np.uint64(1)
    return code


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_set(items: pa.Table, width: int = WIDTH) -> WindowSet:
    """The hash set of a bounded table of ``id`` and ``text``."""
    texts = plain(items["text"])
    words, rows = split_words(texts, ALNUM)
    names = pc.fill_null(plain(items["id"]), "").to_pylist()
    ids = sorted(set(names))
    place = {name: i for i, name in enumerate(ids)}
    item_of_row = np.array([place[n] for n in names], np.int32)
    encoded = words.dictionary_encode()
    numbers = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    first = np.searchsorted(rows, np.arange(len(texts) + 1))
    n_words = np.diff(first)
    lengths = []
    for size in np.unique(np.minimum(n_words, width)):
        if size == 0:
            continue
        own = np.flatnonzero(np.minimum(n_words, width) == size)
        fan = n_words[own] - size + 1
        starts = np.repeat(first[own] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
        items_of = np.repeat(item_of_row[own], fan)
        codes = _codes(numbers, starts, int(size), FACTOR)
        order = np.argsort(codes, kind="stable")
        codes, starts, items_of = codes[order], starts[order], items_of[order]
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        for k in range(size):  # windows of equal codes are told apart by their words
            new[1:] |= numbers[starts[1:] + k] != numbers[starts[:-1] + k]
        window = np.cumsum(new) - 1
        owners = np.unique(window * len(ids) + items_of)
        bounds = np.searchsorted(owners // len(ids), np.arange(window[-1] + 2))
        heads = np.flatnonzero(new)
        lengths.append(
            WindowsOfLength(int(size), codes[heads], starts[heads].astype(np.int32), bounds.astype(np.int32), (owners % len(ids)).astype(np.int32))
        )
    return WindowSet(encoded.dictionary, numbers, ids, lengths)


def _matches(known: WindowSet, windows: WindowsOfLength, numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of true hits and their windows."""
    width, spare = windows.width, len(numbers) - windows.width + 1
    if spare <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    unknown = np.concatenate([[0], np.cumsum(numbers < 0)])
    whole = (unknown[width:] == unknown[:-width]) & (rows[width - 1 :] == rows[:spare])
    starts = np.flatnonzero(whole)
    codes = _codes(numbers, starts, width, FACTOR)
    low = np.searchsorted(windows.codes, codes, side="left")
    high = np.searchsorted(windows.codes, codes, side="right")
    found_starts, found = [], []
    for step in range(int((high - low).max(initial=0))):  # more than one only where codes of windows collide
        some = np.flatnonzero(low + step < high)
        at, window = starts[some], low[some] + step
        same = np.ones(len(at), bool)
        for k in range(width):
            same &= numbers[at + k] == known.numbers[windows.starts[window] + k]
        found_starts.append(at[same])
        found.append(window[same])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_starts), np.concatenate(found)


def scan_slice(known: WindowSet, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[list[str]]]:
    """Words, places of hit words, and ids of items, for each text of a slice."""
    words, rows = split_words(texts, ALNUM)
    size = len(texts)
    n_words = np.bincount(rows, minlength=size)
    numbers = pc.fill_null(pc.index_in(words, value_set=known.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    cover = np.zeros(len(words) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for windows in known.lengths:
        starts, found = _matches(known, windows, numbers, rows)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + windows.width, -1)
        seen = np.unique(np.stack([rows[starts], found], axis=1), axis=0)
        counts = windows.first_item[seen[:, 1] + 1] - windows.first_item[seen[:, 1]]
        before = np.concatenate([[0], np.cumsum(counts)])[:-1]
        at = np.repeat(windows.first_item[seen[:, 1]] - before, counts) + np.arange(counts.sum())
        pairs.append(np.stack([np.repeat(seen[:, 0], counts), windows.item[at]], axis=1))
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    places = np.split(hit - first_word[rows[hit]], np.searchsorted(rows[hit], np.arange(1, size))) if size else []
    items: list[list[str]] = [[] for _ in range(size)]
    for row, item in np.unique(np.concatenate(pairs), axis=0).tolist():
        items[row].append(known.ids[item])
    return n_words, places, items


def _blocks(benchmark: DataFrame, item: str, text: str, max_bytes: int) -> list[DataFrame]:
    """The distinct items, cut by a hash until no block of several items takes more than ``max_bytes``."""
    named = benchmark.select(
        F.coalesce(benchmark[f"`{item}`"].cast("string"), F.lit("")).alias("id"), benchmark[f"`{text}`"].cast("string").alias("text")
    )
    body = F.coalesce("text", F.lit(""))
    lowered = F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_count(lowered, F.lit(f"{WORD.pattern}"))
    rows = named.distinct().withColumn("size", F.octet_length(body) + F.lit(WORD_BYTES) * words + 32)
    whole = rows.agg(F.sum("size")).first()[0] or 0
    if whole <= max_bytes:
        return [rows.select("id", "text")]
    rows = staged(rows, "items")
    parts = -(-whole // max_bytes)
    while True:
        part = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
        sizes = rows.groupBy(part.alias("part")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()  # a row per block
        if all(r["bytes"] <= max_bytes or r["n"] == 1 for r in sizes):
            return [rows.filter(part == r["part"]).select("id", "text") for r in sizes]
        parts *= 2


def scan(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    max_bytes: int = MAX_SET_BYTES,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``hit_words`` (places of hit words).

    Columns of these names are replaced.
    """
    blocks = _blocks(benchmark, item, item_text, max_bytes)
    spark = df.sparkSession
    for number, block in enumerate(blocks):
        known = spark.sparkContext.broadcast(window_set(block.toArrow(), width))
        earlier = number > 0

        def compute(texts: pa.Array, batch: pa.RecordBatch, known=known, earlier=earlier) -> list:
            n_words, places, items = scan_slice(known.value, texts)
            if earlier:
                names = batch.schema.names
                before = batch.column(names.index("_places")).to_pylist(), batch.column(names.index("_items")).to_pylist()
                places = [np.union1d(p, np.array(q, np.int64)) for p, q in zip(places, before[0], strict=True)]
                items = [sorted({*p, *q}) for p, q in zip(items, before[1], strict=True)]
            return [n_words, [len(p) for p in places], items, [p.tolist() for p in places]]

        df = append_columns(df, text, FIELDS, compute).drop("_places", "_items")
        if len(blocks) > 1:
            df = df.withColumn("_places", F.col("hit_words")).withColumn("_items", F.col("items"))
            df = staged(df, "decontaminate")
    return df.drop("_places", "_items")


def cut(text: str, places: list[int], fill: str = " ") -> str:
    """``text`` without its runs of hit words; each run with the separators inside goes and leaves ``fill``."""
    hit, out, last = set(places), [], 0
    start = stop = None
    for i, m in enumerate(WORD.finditer(text.translate(_UPPER))):
        if i in hit:
            start, stop = (m.start() if start is None else start), m.end()
        elif start is not None:
            out += [text[last:start], fill]
            start, last = None, stop
    if start is not None:
        out += [text[last:start], fill]
        last = stop
    return "".join([*out, text[last:]])


@F.pandas_udf(T.StringType())
def _cut_texts(text, places):
    import pandas as pd

    return pd.Series([t if t is None or not len(p) else cut(t, list(p)) for t, p in zip(text, places, strict=True)])


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """``df`` without contaminated rows (``remove="documents"``) or without the hit spans (``"spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    added = [f.name for f in FIELDS]
    scanned = scan(df, benchmark, text=text, **options)
    if remove == "documents":
        return scanned.filter("n_hit = 0").drop(*added)
    clean = F.when(F.col("n_hit") > 0, _cut_texts(F.col(text), F.col("hit_words"))).otherwise(F.col(text))
    return scanned.withColumn(text, clean).drop(*added)
