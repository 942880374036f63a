"""SentencePiece encoding and decoding with seeded merge-dropout.

A unit is a run of blanks and what follows up to the next blank; no piece of a merge-type model crosses units, which
is checked when a model is loaded. The agenda of a unit holds its possible merges, best score first, leftmost first.
A merge is skipped when the hash of (seed, variant, unit, place) says so, so a segmentation depends on nothing but
those: retries, partitions and neighbours don't change it. A text's variant is derived from its key, so a word has up
to ``variants`` segmentations in one run, and a new seed gives new ones; each is worked out once per batch. Without dropout the result is the model's own.

Characters the model doesn't know become byte pieces, and so does a literal U+2581, which the model would turn into a
blank: decoding gives back every text exactly. Empty and null texts have no pieces and decode to the empty text.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagloom.llm.batches import append_columns, bound_batches, kept_by_worker

BLANK = "▁"
DROPOUT, SEED, VARIANTS = 0.1, 1, 4
LONGEST_TOGETHER = 40
_UNIT = re.compile(" +[^ ]*|[^ ]+")


class PieceModel:
    """Pieces and scores of a merge-type model file with byte fallback."""

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(len(self.pieces))]
        self.number = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.rank = {p: -model.get_score(i) for p, i in self.number.items()}
        if any(BLANK in p.lstrip(BLANK) for p in self.number):
            raise ValueError("pieces of this model cross word borders")
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in self.byte):
            raise ValueError("this model has no byte pieces")
        self.pairs = PairTable(self)

    def segment(self, unit: str, key: int, dropout: float) -> list[int]:
        """Ids of the pieces of ``unit``, in which blanks are written as in the model."""
        rank, limit = self.rank, int(dropout * (1 << 32))
        seed = xxhash.xxh64_intdigest(unit, key) | 1
        size = len(unit)
        stop = list(range(1, size + 1))  # end of the symbol that starts here, 0 where none does
        before = list(range(-1, size))
        agenda: list[tuple[float, int, int, int]] = []

        def propose(start: int, middle: int, end: int) -> None:
            order = rank.get(unit[start:end])
            if order is None:
                return
            if limit and skip_hash(seed, start, middle, end) < limit:
                return
            heapq.heappush(agenda, (order, start, middle, end))

        for i in range(size - 1):
            propose(i, i + 1, i + 2)
        while agenda:
            _, start, middle, end = heapq.heappop(agenda)
            if stop[start] != middle or stop[middle] != end:
                continue
            stop[start], stop[middle] = end, 0
            if end < size:
                before[end] = start
                propose(start, end, stop[end])
            if start:
                propose(before[start], start, end)
        out: list[int] = []
        at = 0
        while at < size:
            piece = unit[at : stop[at]]
            number = self.number.get(piece)
            if number is None:
                out += [self.byte[b] for b in piece.encode()]
            else:
                out.append(number)
            at = stop[at]
        return out

    def odd(self, text: str, key: int, dropout: float) -> list[int]:
        """Pieces of a text with literal blank signs: those become bytes and end their units."""
        out: list[int] = []
        for i, part in enumerate((" " + text).split(BLANK)):
            if i:
                out += [self.byte[b] for b in BLANK.encode()]
            for unit in _UNIT.findall(part):
                out += self.segment(unit.replace(" ", BLANK), key, dropout)
        return out


def skip_hash(seed, start, middle, end):
    """32 bits that decide on a merge, for numbers or for arrays of uint64."""
    one, full = (np.uint64, None) if isinstance(seed, np.ndarray) else (int, 0xFFFFFFFFFFFFFFFF)
    mixed = seed * (start * one(0x9E3779B1) + middle * one(0x85EBCA77) + end * one(0xC2B2AE3D) + one(1))
    mixed = mixed if full is None else mixed & full
    mixed = (mixed ^ (mixed >> one(29))) * one(0xBF58476D1CE4E5B9)
    mixed = mixed if full is None else mixed & full
    return mixed >> one(32)


class PairTable:
    """Merges as arrays: what a pair of symbols becomes and how early, found by hashing."""

    NEVER = np.int32(2**31 - 1)
    BITS = 20
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, model: PieceModel):
        letters = sorted({c for p in model.number for c in p})
        # pieces keep their ids; a letter that is no piece of its own gets a number beyond
        self.symbol = dict(model.number)
        for c in letters:
            self.symbol.setdefault(c, len(model.pieces) + len(self.symbol))
        self.points = np.array([ord(c) for c in letters], np.uint32)
        self.of_point = np.array([self.symbol[c] for c in letters], np.int64)
        self.is_piece = np.array([c in model.number for c in letters])
        orders = {r: i for i, r in enumerate(sorted(set(model.rank.values())))}
        codes, merged, order = [], [], []
        for piece, number in model.number.items():
            for cut in range(1, len(piece)):
                left, right = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if left is not None and right is not None:
                    codes.append(left << 32 | right)
                    merged.append(number)
                    order.append(orders[model.rank[piece]])
        size = 1 << self.BITS
        self.codes, self.merged, self.order = np.zeros(size + 64, np.uint64), np.zeros(size + 64, np.int64), np.full(size + 64, self.NEVER)
        codes = np.array(codes, np.uint64) + np.uint64(1)
        place = (codes * self.FACTOR >> np.uint64(64 - self.BITS)).astype(np.int64)
        waiting = np.arange(len(codes))
        self.probes = 0
        while len(waiting):
            self.probes += 1
            free = waiting[self.codes[place[waiting]] == 0]
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self.codes[place[won]], self.merged[place[won]], self.order[place[won]] = codes[won], np.array(merged)[won], np.array(order)[won]
            waiting = np.setdiff1d(waiting, won)
            place[waiting] += 1

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and result of each merge; ``NEVER`` where there is none."""
        code = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) + np.uint64(1)
        place = (code * self.FACTOR >> np.uint64(64 - self.BITS)).astype(np.int64)
        for _ in range(self.probes):
            other = (self.codes[place] != code) & (self.codes[place] != 0)
            if not other.any():
                break
            place += other
        hit = self.codes[place] == code
        return np.where(hit, self.order[place], self.NEVER), self.merged[place]


def segment_all(model: PieceModel, units: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` of all units at once: their ids one after another, and how many each has.

    Units of equal length step together: in a round each takes the first merge of its agenda. Long units and those with
    letters the model doesn't know go one by one.
    """
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    table = model.pairs
    near = np.minimum(np.searchsorted(table.points, points), len(table.points) - 1)
    known = (table.points[near] == points) & table.is_piece[near]
    single = ~known & (points < 128)  # one byte, one piece, no merges
    starts = np.cumsum(sizes) - sizes
    alone = sizes > LONGEST_TOGETHER
    alone |= np.add.reduceat(~(known | single), starts) > 0 if len(units) else alone
    lengths = np.zeros(len(units), np.int64)
    rows, blocks = [], []
    for k in np.flatnonzero(alone).tolist():
        ids = model.segment(units[k], int(keys[k]), dropout)
        lengths[k] = len(ids)
        rows.append(np.array([k]))
        blocks.append(np.array(ids, np.int64)[None, :])
    limit = np.uint64(int(dropout * (1 << 32)))
    seeds = np.zeros(len(units), np.uint64)
    if limit:
        digest = xxhash.xxh64_intdigest
        seeds = np.fromiter((digest(u, k) | 1 for u, k in zip(units, keys.tolist(), strict=True)), np.uint64, len(units))
    symbols = table.of_point[near]
    symbols[single] = np.array(model.byte)[points[single]]

    def rated(row, left, right, start, middle, end):
        order, merged = table.find(left, right)
        if limit:
            where = (start.astype(np.uint64), middle.astype(np.uint64), end.astype(np.uint64))
            order = np.where(skip_hash(seeds[row], *where) < limit, table.NEVER, order)
        return order, merged

    for size in np.unique(sizes[~alone]).tolist():
        row = np.flatnonzero(~alone & (sizes == size))
        symbol = symbols[starts[row][:, None] + np.arange(size)]
        edge = np.broadcast_to(np.arange(size + 1), (len(row), size + 1)).copy()
        order, merged = rated(
            np.repeat(row, size - 1), symbol[:, :-1].ravel(), symbol[:, 1:].ravel(), edge[:, :-2].ravel(), edge[:, 1:-1].ravel(), edge[:, 2:].ravel()
        )
        order, merged = order.reshape(len(row), size - 1), merged.reshape(len(row), size - 1)
        while True:
            best = order.argmin(axis=1) if order.shape[1] else np.zeros(len(row), np.int64)
            going = order[np.arange(len(row)), best] != table.NEVER if order.shape[1] else np.zeros(len(row), bool)
            if not going.all():
                done = ~going
                rows.append(row[done])
                blocks.append(symbol[done])
                lengths[row[done]] = symbol.shape[1]
                row, symbol, edge, order, merged, best = (x[going] for x in (row, symbol, edge, order, merged, best))
            if not len(row):
                break
            each, width = np.arange(len(row)), symbol.shape[1]
            symbol[each, best] = merged[each, best]
            keep = np.arange(width - 1) + (np.arange(width - 1) > best[:, None])
            symbol = np.take_along_axis(symbol, keep, 1)
            edge = np.take_along_axis(edge, np.arange(width) + (np.arange(width) > best[:, None]), 1)
            # the pair that merged goes; the pairs on either side of it are rated anew
            keep = np.arange(width - 2) + (np.arange(width - 2) >= best[:, None])
            order, merged = np.take_along_axis(order, keep, 1), np.take_along_axis(merged, keep, 1)
            for side in (-1, 0):
                at = best + side
                some = np.flatnonzero((at >= 0) & (at < width - 2))
                r, c = each[some], at[some]
                order[r, c], merged[r, c] = rated(row[r], symbol[r, c], symbol[r, c + 1], edge[r, c], edge[r, c + 1], edge[r, c + 2])
    values = np.zeros(int(lengths.sum()), np.int32)
    first = np.cumsum(lengths) - lengths
    for r, block in zip(rows, blocks, strict=True):
        values[first[r][:, None] + np.arange(block.shape[1])] = block
    return values, lengths


@lru_cache(maxsize=2)
def bytes_of_pieces(content: bytes) -> np.ndarray:
    """What each piece stands for; control pieces stand for nothing. All that decoding needs of a model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            hidden = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            out.append(b"" if hidden else piece.replace(BLANK, " ").encode())
    return np.array(out, object)


@kept_by_worker(maxsize=2)
def _loaded(content: bytes) -> PieceModel:
    return PieceModel(content)


def variant_key(key: str | None, seed: int, variants: int) -> int:
    return seed * 1_000_003 + (xxhash.xxh64_intdigest(key or "", seed) % variants if variants > 1 else 0)


def encode_slice(model: PieceModel, texts: pa.Array, keys: list[int], dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and the number of each text's."""
    sizes = np.zeros(len(texts), np.int64)
    parts: list[tuple[int, np.ndarray]] = []
    odd = pc.match_substring(texts, BLANK).to_numpy(zero_copy_only=False)
    spaced = pc.match_substring_regex(texts, "^ |  | $").to_numpy(zero_copy_only=False)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(odd).tolist():
        ids = model.odd(texts[row].as_py(), keys[row], dropout)
        parts.append((row, np.array(ids, np.int32)))
    usual, irregular = np.flatnonzero(~(odd | spaced | empty)), np.flatnonzero(spaced & ~odd)
    split = pc.split_pattern(texts.take(pa.array(usual)), " ")
    words = [split.flatten()]
    counts = [pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)]
    # a unit without its first blank; only texts with runs of blanks have units that begin with more
    runs = [[u[1:] for u in _UNIT.findall(" " + texts[row].as_py())] for row in irregular.tolist()]
    words.append(pa.array([u for r in runs for u in r], pa.string()))
    counts.append(np.fromiter(map(len, runs), np.int64, len(runs)))
    rows, count = np.concatenate([usual, irregular]), np.concatenate(counts)
    encoded = pa.concat_arrays([w.cast(pa.string()) for w in words]).dictionary_encode()
    names, own = np.unique(np.array(keys, np.int64), return_inverse=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(names)) + np.repeat(own[rows], count)
    distinct, place = np.unique(codes, return_inverse=True)
    if len(distinct):
        spelled = encoded.dictionary.to_pylist()
        units = [BLANK + (w.replace(" ", BLANK) if " " in w else w) for w in (spelled[i] for i in (distinct // len(names)).tolist())]
        values, lengths = segment_all(model, units, names[distinct % len(names)], dropout)
        first = np.cumsum(lengths) - lengths
        n = lengths[place]
        done = np.cumsum(n)
        ids = values[np.repeat(first[place] - (done - n), n) + np.arange(done[-1])]
        ends = done[np.cumsum(count) - 1]
        parts += zip(rows.tolist(), np.split(ids, ends[:-1]), strict=True)
    for row, ids in parts:
        sizes[row] = len(ids)
    parts.sort(key=lambda p: p[0])
    return (np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)), sizes


def encode(
    df: DataFrame,
    model_path: str,
    key: str = "doc_id",
    text: str = "text",
    dropout: float = DROPOUT,
    seed: int = SEED,
    variants: int = VARIANTS,
) -> DataFrame:
    """``df`` with ``pieces``, the ids of each text's pieces. ``model_path`` is a file the driver can read."""
    if not 0 <= dropout <= 1 or variants < 1:
        raise ValueError("dropout lies between 0 and 1, variants are one or more")
    with open(model_path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    _loaded(content.value)  # refuses an unfit model here rather than in a task
    named = df.withColumn("_variant", df[f"`{key}`"].cast("string"))

    def compute(texts: pa.Array, batch: pa.RecordBatch) -> list:
        keys = [variant_key(k, seed, variants) for k in batch.column(batch.schema.names.index("_variant")).to_pylist()]
        ids, sizes = encode_slice(_loaded(content.value), texts, keys, dropout)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))]

    return append_columns(named, text, [T.StructField("pieces", T.ArrayType(T.IntegerType()))], compute, _loaded).drop("_variant")


def decode_slice(words: np.ndarray, ids: pa.ListArray) -> list[str]:
    """Texts of rows of ids; ``words`` comes from ``bytes_of_pieces``."""
    out = []
    for row in ids:
        pieces = row.values
        if pieces is None or len(pieces) == 0:
            out.append("")
            continue
        text = b"".join(words[pieces.to_numpy(zero_copy_only=False)].tolist()).decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def decode(df: DataFrame, model_path: str, pieces: str = "pieces") -> DataFrame:
    """``df`` with ``decoded``, the text of its pieces."""
    with open(model_path, "rb") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    bound_batches(df.sparkSession)
    own = [c for c in df.columns if c.lower() != "decoded"]
    rows = df.select(*[df[f"`{c}`"] for c in own])
    schema = T.StructType([*rows.schema, T.StructField("decoded", T.StringType())])
    at = own.index(pieces)

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                texts = pa.array(decode_slice(bytes_of_pieces(content.value), part.column(at)), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return rows.mapInArrow(run, schema)
