"""Near-duplicates by SimHash fingerprints, compared exactly in tiles.

Fingerprints are 64 bits wide; two texts are linked when theirs differ in at most ``radius`` bits. Distinct
fingerprints are dealt into cells by the population counts of their parts (two halves, or four quarters for large
tables). Fingerprints of two cells differ in at least as many bits as the counts of the cells do, so pairs of cells
that lie further apart than the radius are skipped and all other pairs are compared by numpy, tile against tile. The
number of parts changes the work, not the result.

Equal fingerprints are compared once. A pair of tiles gives a spanning forest of its links, at most one link per
fingerprint, so a large group of near copies never becomes all of its pairs.

Texts without words (null, empty, blanks) have fingerprint zero and are linked like any other. Keys should be unique;
repeated keys give repeated rows. A null key never becomes the smallest key of a group that has others. A very long text
costs its length once and makes one fingerprint. Names that begin with ``_`` are work columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import BLANKS, append_columns, split_words
from tagloom.llm.components import components
from tagloom.operators.sizing import staged

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 4096
#: Up to this many fingerprints two parts make cells that fill a tile; beyond, four parts do.
TWO_PARTS_UP_TO = 1 << 20
_PIECE = 1 << 17


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned fingerprints of a slice of texts."""
    size = len(texts)
    words, rows = split_words(texts, BLANKS)
    if len(words) == 0:
        return np.zeros(size, np.uint64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().encode()
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n_words = np.bincount(rows, minlength=size)
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(size), n)
    head = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    tail = np.minimum(head + shingle, first[owner] + n_words[owner]) - 1
    counts = np.zeros((size, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, len(owner), _PIECE):
        part = slice(a, a + _PIECE)
        spans = zip(starts[head[part]].tolist(), ends[tail[part]].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, at = np.unique(owner[part], return_index=True)
        counts[own] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    majority = (2 * counts > n[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``df`` with ``fingerprint``, the 64 bits as a signed number."""

    def compute(texts: pa.Array, _: pa.RecordBatch) -> list:
        return [fingerprints(texts, shingle, seed).view(np.int64)]

    return append_columns(df, text, [T.StructField("fingerprint", T.LongType())], compute)


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _cell(fingerprint: Column, parts: int) -> Column:
    """Population counts of the parts as digits to ``BASE``, which leaves room for the radius on either side."""
    width = 64 // parts
    cell = F.lit(0).cast("bigint")
    for k in range(parts):
        part = F.shiftrightunsigned(fingerprint, width * k).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        cell = cell + F.bit_count(part).cast("bigint") * (BASE**k)
    return cell


BASE = 128


def _offsets(parts: int, radius: int) -> list[int]:
    """Distances to the cells a cell meets: itself, and one of each two that lie opposite each other."""
    steps = (s for s in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, s)) <= radius)
    return sorted(d for d in (sum(x * BASE**k for k, x in enumerate(s)) for s in steps) if d >= 0)


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles that connect whatever all links within ``radius`` connect."""
    left, right = [], []
    rows = max(1, (1 << 20) // max(1, len(b)))
    for start in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[start : start + rows, None] ^ b[None, :]) <= radius)
        left.append(i + start)
        right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    if len(i) <= len(a) + len(b):
        return a[i], b[j]
    # smallest label spreads along all links; then each node needs the one link to its label
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)][i], place[len(a) :][j]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``radius``; ``distinct`` has them in its one column."""
    (name,) = distinct.columns
    nodes = distinct.select(F.col(name).alias("fp"))
    if parts is None:
        parts = 2 if nodes.count() <= TWO_PARTS_UP_TO else 4
    placed = nodes.withColumn("cell", _cell(F.col("fp"), parts))
    # at most (64 / parts + 1) ** parts cells: 1,089 for two parts, 83,521 for four
    sizes = F.broadcast(placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks")))
    dealt = placed.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    tiles = staged(dealt.groupBy("cell", "chunk").agg(F.collect_list("fp").alias("fps")), "tiles")
    offset = F.explode(F.array(*[F.lit(d).cast("bigint") for d in _offsets(parts, radius)])).alias("offset")
    keys = tiles.select(F.col("cell").alias("from"), F.col("chunk").alias("visitor_chunk"), "fps", offset)
    visitors = keys.select((F.col("from") + F.col("offset")).alias("cell"), "visitor_chunk", "offset", F.col("fps").alias("visitors"))
    met = visitors.join(F.broadcast(tiles.select("cell").distinct()), "cell", "left_semi")
    pairs = met.join(tiles, "cell").filter((F.col("offset") != 0) | (F.col("chunk") <= F.col("visitor_chunk")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, visiting = batch.column(0), batch.column(1)
            found = [np.zeros((2, 0), np.int64)]
            for k in range(len(batch)):
                a, b = (np.asarray(x[k].values, np.int64).view(np.uint64) for x in (home, visiting))
                u, v = _forest(a, b, radius)
                found.append(np.stack([u, v]).view(np.int64)[:, u != v])
            u, v = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])

    return pairs.select("fps", "visitors").mapInArrow(compare, "a bigint, b bigint")


def _rooted(rows: DataFrame, radius: int, parts: int | None, tile: int) -> DataFrame:
    """``fingerprint`` and ``_root``, which names its group, of all fingerprints in ``rows``."""
    nodes = staged(rows.select("fingerprint").distinct(), "nodes")
    roots = components(links(nodes, radius, parts, tile))
    joined = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("_root"))


def near_groups(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    parts: int | None = None,
    tile: int = TILE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id``, the smallest key that links reach, for every row."""
    rows = staged(with_fingerprint(df.select(key, text), text, shingle).select(key, "fingerprint"), "fingerprints")
    first = staged(rows.groupBy("fingerprint").agg(F.min(key).alias("_first")), "nodes")
    rooted = first.join(_rooted(first, radius, parts, tile), "fingerprint")
    smallest = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rows.join(rooted.join(smallest, "_root").select("fingerprint", "component_id"), "fingerprint").select(
        key, "fingerprint", "component_id"
    )


def keep_one(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    parts: int | None = None,
    tile: int = TILE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest key (null last), of those the smallest text hash.

    Rows that agree in key and text are one document, of which one row stays.
    """
    body = F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    printed = with_fingerprint(df.select(key, text, body.alias("_body")), text, shingle)
    rows = staged(printed.select(F.col(key).alias("_key"), "_body", "fingerprint"), "fingerprints")
    documents = rows.groupBy("_key", "_body", "fingerprint").agg(F.count("*").alias("_rows"))
    grouped = staged(documents.join(_rooted(rows, radius, parts, tile), "fingerprint"), "groups")
    name = F.struct(F.col("_key").isNull().alias("z"), F.col("_key").alias("k"), F.col("_body").alias("b"))
    heads = grouped.groupBy("_root").agg(F.min(name).alias("_head"))
    judged = grouped.join(heads, "_root").withColumn("_stays", F.col("_head").eqNullSafe(name))
    marked = judged.filter("NOT _stays OR _rows > 1").select("_key", "_body", "_stays")
    met = df[key].eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_body"))
    left = df.withColumn("_own", body).join(staged(marked, "others"), met, "left").filter(F.coalesce("_stays", F.lit(True)))
    # rows of a repeated document are combined before they are shuffled
    once = left.filter("_stays IS NOT NULL").dropDuplicates(["_key", "_own"])
    kept = left.filter("_stays IS NULL").unionByName(once)
    return kept.select(*[f"`{c}`" for c in df.columns])
