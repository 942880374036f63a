"""Class-based n-gram scores: exchange clustering puts words into classes, classes follow each other, words come out.

log p(text) = sum of log p(class | class before) + log p(word | class) over its words and one end.

* Every listed word that occurs ``LEAST`` times or more is clustered. Rarer words belong to fixed classes by their form
  (length, letters beyond ASCII, a last character that is no letter), so an unseen word has a class too. The end is a
  class of its own and stands before the first word. The number of classes grows with the cube root of the vocabulary.
* Exchange runs over one row per clustered word, its counts before and after other words. The most frequent words go
  first, all others being in their forms. Then each form becomes a class like any other, in which its words begin, and
  every word asks for the class that raises the likelihood of the class bigrams most; it moves if that gains more than
  ``PRICE``, half of all words in a round. The best assignment of all rounds stays.
* Words are listed by their counts and broadcast, at most ``LISTED`` of up to ``LISTED_BYTES`` bytes each. All other
  words of all texts meet their counts in a shuffled join, so counts are exact for every word of every text.

Bounded by parameters and held by the driver: the listed words, a class for each, and matrices over classes. Counts of
words and of pairs of words grow with the corpus and stay in tables.

Null texts count as empty and have one token, the end. Without training texts every count is zero. Keys may repeat or be
null; rows are told apart by a number of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import BLANKS, append_columns, bound_batches, layout, plain, row_slices, split_words
from tagloom.operators.sizing import staged

LISTED, LISTED_BYTES = 1 << 18, 64
#: Times a word must occur to be clustered, and how many of the most frequent ones are clustered first.
LEAST = 2
CORE = 2048
ROUNDS, WHOLE_ROUNDS = 12, 4
#: What a move of any word must add to the log-likelihood of the training texts.
PRICE = 3.0
#: Rounds at a lower price may pass through worse assignments to better ones.
PATIENCE = 1e-6
PRIOR = 5.0
FORMS = 16
#: Pairs of symbols are shuffled and stored in blocks of about so many, since a row for each costs more than its count.
BLOCK = 1 << 19
#: Of a block, a row has at most so many: Parquet's pages hold 100 rows and more, and are compressed outside the heap.
ROW = 1 << 12
BLOCKS = "part int, pairs binary, counts binary"
#: An odd number, so that multiplying 64-bit numbers by it can be undone.
MIX = 0x9E3779B97F4A7C15
_SIZES = np.array([4, 8, 12])


def forms(words: pa.Array) -> np.ndarray:
    """Fixed classes by form: length, any letter beyond ASCII, last character no letter."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    foreign = ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False).astype(bool)
    last = pc.match_substring_regex(words, r"[!-/:-@\[-`{-~0-9]$").to_numpy(zero_copy_only=False).astype(bool)
    return np.searchsorted(_SIZES, sizes) * 4 + foreign * 2 + last


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts (one column), combined per batch before the shuffle; the end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = plain(batch.column(0))
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([len(rows)], pa.int64())], names=["word", "n"])
            for start, stop in row_slices(rows, 8 << 20):
                counted = pc.value_counts(split_words(rows.slice(start, stop - start), BLANKS)[0])
                yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "n"])

    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def listed_words(counts: DataFrame, most: int = LISTED) -> pa.Table:
    """Words above the lowest count that leaves no more than ``most`` of them, the most frequent first."""
    short = counts.filter((F.col("word") != "") & (F.octet_length("word") <= LISTED_BYTES))
    # counts in steps of a 64th of an octave: at most a few thousand steps, exact below 64
    step = F.when(F.col("n") < 64, F.col("n").cast("double")).otherwise(F.floor(F.log2("n") * 64) - 6 * 64 + 64.0)
    steps = short.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    room, least = most, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        if row["words"] > room:
            break
        room, least = room - row["words"], row["least"]
    if least is None:
        return pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    chosen = short.filter(F.col("n") >= least).toArrow()
    return chosen.sort_by([("n", "descending"), ("word", "ascending")])


@dataclass
class Vocabulary:
    words: pa.Array
    counts: np.ndarray
    clustered: int

    @property
    def end(self) -> int:
        return self.clustered + FORMS

    def symbols(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word in the list or -1, and its symbol: itself if clustered, else its form."""
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        symbols, rest = place.copy(), np.flatnonzero((place < 0) | (place >= self.clustered))
        symbols[rest] = self.clustered + forms(words.take(pa.array(rest)))
        return place, symbols


def with_ends(values: np.ndarray, rows: np.ndarray, size: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The stream of all rows with an end behind each, and the row of each item."""
    at = np.searchsorted(rows, np.arange(size), side="right")
    return np.insert(values, at, end), np.insert(rows, at, np.arange(size))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number per pair of symbols, spread evenly over 64 bits; ``_parted`` is the way back."""
    return (a.astype(np.uint64) << 32 | b.astype(np.uint64)) * np.uint64(MIX)


def _parted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = codes * np.uint64(pow(MIX, -1, 1 << 64))
    return (pairs >> 32).astype(np.int64), (pairs & 0xFFFFFFFF).astype(np.int64)


def _numbers(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The numbers that a column holds as bytes, one row after another."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(layout(column)[1], kind)


def _rows_of_bytes(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A row of bytes for the numbers from each bound to the next."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _starts(values: np.ndarray) -> np.ndarray:
    """Where stretches of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of each."""
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    first = _starts(codes)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _dealt(codes: np.ndarray, n: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Codes in order and their counts as blocks, each of them for one of ``parts`` parts."""
    for start in range(0, len(codes), 32 * ROW):
        some, counts = codes[start : start + 32 * ROW], n[start : start + 32 * ROW].astype("<i8")
        part = ((some >> 32) * np.uint64(parts) >> 32).astype(np.int32)
        first = np.union1d(_starts(part), np.arange(0, len(part), ROW))
        bounds = np.append(first, len(part))
        yield pa.RecordBatch.from_arrays([pa.array(part[first]), _rows_of_bytes(some, bounds), _rows_of_bytes(counts, bounds)], names=["part", "pairs", "counts"])


def _combined(blocks: DataFrame, parts: int) -> DataFrame:
    """Blocks in which every pair occurs once."""

    def add(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_dealt(*_summed(_numbers(table["pairs"], "<u8"), _numbers(table["counts"], "<i8")), parts))

    return blocks.groupBy("part").applyInArrow(add, BLOCKS)


def parts_for(pairs: int) -> int:
    """Parts for at most so many pairs, so that each of them has about ``BLOCK``."""
    return pairs // BLOCK + 1


def bigrams(texts: DataFrame, vocabulary: Vocabulary, parts: int = 1) -> DataFrame:
    """Counts of symbol after symbol over all texts as blocks: bytes of mixed pairs and of their counts.

    They are combined per slice before the shuffle, which moves a row per slice and part instead of one per pair.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = plain(batch.column(0))
            for start, stop in row_slices(rows, 8 << 20):
                words, row = split_words(rows.slice(start, stop - start), BLANKS)
                stream, _ = with_ends(known.symbols(words)[1], row, stop - start, known.end)
                pairs = _mixed(np.concatenate([[known.end], stream[:-1]]), stream)
                yield from _dealt(*np.unique(pairs, return_counts=True), parts)

    return _combined(texts.mapInArrow(count, BLOCKS), parts)


def blocks_of(pairs: DataFrame) -> DataFrame:
    """Blocks of a table with a row ``a``, ``b``, ``n`` per pair."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield from _dealt(*_summed(_mixed(a, b), n), 1)

    return pairs.select("a", "b", "n").mapInArrow(pack, BLOCKS)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _fit(matrix: np.ndarray) -> float:
    """What the classes add to the likelihood of the training texts."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def class_count(words: int) -> int:
    """Classes for a vocabulary of so many words, besides those that begin as forms."""
    return max(2, round(words ** (1 / 3) / 2))


def _one_side(counts: np.ndarray, across: np.ndarray, own: np.ndarray, matrix: np.ndarray, movable: int) -> np.ndarray:
    """What a word's ``counts`` of classes add to ``x log x`` of each row they may be put into.

    ``matrix`` still holds the word in its ``own`` class: along the row as ``counts``, along the column as ``across``.
    """
    word, other = np.nonzero(counts)
    n = counts[word, other]
    # most words meet a class once or twice: what a class and a count give is worked out once for all of them
    kinds, which = np.unique(n.astype(np.int64) * len(matrix) + other, return_inverse=True)
    more, base = (kinds // len(matrix))[:, None], matrix[:movable, kinds % len(matrix)].T.astype(float)
    gained = (_xlogx(base + more) - _xlogx(base))[which]
    # but for cells that hold the word itself
    inside = np.flatnonzero((own[word] < movable) & (other != own[word]))
    base = np.maximum(matrix[own[word[inside]], other[inside]] - n[inside], 0)
    gained[inside, own[word[inside]]] = _xlogx(base + n[inside]) - _xlogx(base)
    at_own = np.flatnonzero(other == own[word])
    base = matrix[:movable, other[at_own]].T - across[word[at_own], :movable]
    mine = np.flatnonzero(own[word[at_own]] < movable)
    base[mine, own[word[at_own[mine]]]] -= n[at_own[mine]]
    base = np.maximum(base, 0)
    gained[at_own] = _xlogx(base + n[at_own, None]) - _xlogx(base)
    out = np.zeros((len(counts), movable))
    if len(word):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.add.reduceat(gained, first, axis=0)
    sums = matrix.sum(1)[:movable] - across[:, :movable]
    mine = np.flatnonzero(own < movable)
    total = counts.sum(1)
    sums[mine, own[mine]] -= total[mine]
    sums = np.maximum(sums, 0)
    return out - (_xlogx(sums + total[:, None]) - _xlogx(sums))


def best_classes(after: np.ndarray, before: np.ndarray, own: np.ndarray, matrix: np.ndarray, movable: int) -> tuple[np.ndarray, np.ndarray]:
    """Class each word should move to, and the gain; a word in a class that isn't movable always moves.

    ``after`` and ``before`` hold a row per word, the counts of classes beside it.
    """
    gain = _one_side(after, before, own, matrix, movable) + _one_side(before, after, own, matrix.T, movable)
    to = gain.argmax(axis=1)
    rows = np.arange(len(own))
    stay = np.where(own < movable, gain[rows, np.minimum(own, movable - 1)], -np.inf)
    return to, gain[rows, to] - stay


def best_class(after: np.ndarray, before: np.ndarray, own: int, matrix: np.ndarray, movable: int) -> tuple[int, float]:
    """The same for one word."""
    to, gain = best_classes(after[None], before[None], np.array([own]), matrix, movable)
    return int(to[0]), float(gain[0])


def neighbours(pairs: DataFrame, parts: int = 1) -> DataFrame:
    """One staged row per symbol: the symbols ``before`` and ``after`` it and how often, packed as bytes.

    ``pairs`` are blocks of ``bigrams`` or rows ``a``, ``b``, ``n``. Every round reads the bytes again without taking
    them apart in the JVM.
    """
    blocks = blocks_of(pairs) if "a" in pairs.columns else pairs

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _parted(_numbers(batch.column(0), "<u8"))
            side, link = np.concatenate([2 * b, 2 * a + 1]), np.concatenate([a, b])
            n = np.tile(_numbers(batch.column(1), "<i8"), 2)
            part = ((side >> 1) * (MIX >> 32) & 0xFFFFFFFF) * parts >> 32
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            part = part[order].astype(np.int32)
            first = _starts(part)
            bounds = np.append(first, len(part))
            columns = [_rows_of_bytes(x[order].astype(kind), bounds) for x, kind in ((side, "<i4"), (link, "<i4"), (n, "<i8"))]
            yield pa.RecordBatch.from_arrays([pa.array(part[first]), *columns], names=["part", "sides", "links", "counts"])

    def gather(table: pa.Table) -> pa.Table:
        # every symbol meets every other one at most twice, so a row is bounded by the number of symbols
        sides, links, n = (_numbers(table[name], kind) for name, kind in (("sides", "<i4"), ("links", "<i4"), ("counts", "<i8")))
        order = np.argsort(sides)
        sides, links, n = sides[order], links[order], n[order]
        word = sides >> 1
        word = word[_starts(word)]
        columns = []
        for side in (0, 1):
            own = np.flatnonzero((sides & 1) == side)
            bounds = np.append(np.searchsorted(sides[own], 2 * word), len(own))
            columns += [_rows_of_bytes(links[own], bounds), _rows_of_bytes(n[own], bounds)]
        rows = pa.table([pa.array(word), *columns], names=["word", "before", "before_n", "after", "after_n"])
        return pa.Table.from_batches(rows.to_batches(CHUNK))

    dealt = blocks.select("pairs", "counts").mapInArrow(deal, "part int, sides binary, links binary, counts binary")
    rows = dealt.groupBy("part").applyInArrow(gather, "word int, before binary, before_n binary, after binary, after_n binary")
    return staged(rows, "neighbours")


def _links(links: pa.Array, counts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of some symbols, how often each occurs, and how many links each symbol has."""
    sizes = pc.binary_length(links).to_numpy(zero_copy_only=False) // 4
    return _numbers(links, "<i4"), _numbers(counts, "<i8"), sizes


def _profiles(batch: pa.RecordBatch, of: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of a batch, some at a time, with their counts of classes before and after them."""
    for start in range(0, len(batch), CHUNK):
        some = batch.slice(start, CHUNK)
        seen = []
        for column in (1, 3):
            links, counts, sizes = _links(some.column(column), some.column(column + 1))
            place = np.repeat(np.arange(len(some)) * total, sizes) + of[links]
            seen.append(np.bincount(place, counts, len(some) * total).reshape(-1, total))
        yield some.column(0).to_numpy(zero_copy_only=False), *seen


CHUNK = 512


def class_matrix(rows: DataFrame, of: np.ndarray, total: int) -> np.ndarray:
    """Counts of class after class; a cell per pair of classes reaches the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = shared.value, np.zeros(total * total)
        for batch in batches:
            links, counts, sizes = _links(batch.column(1), batch.column(2))
            place = np.repeat(of[batch.column(0).to_numpy(zero_copy_only=False)] * total, sizes) + of[links]
            sums += np.bincount(place, counts, total * total)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], names=["cell", "n"])

    cells = rows.select("word", "after", "after_n").mapInArrow(run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(total * total)
    matrix[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    shared.destroy()
    return matrix.reshape(total, total)


def wanted_moves(rows: DataFrame, of: np.ndarray, matrix: np.ndarray, movable: int, size: int, price: float) -> pa.Table:
    """``word`` and ``to`` of the clustered words that gain more than ``price`` by a move."""
    shared = rows.sparkSession.sparkContext.broadcast((of, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, matrix = shared.value
        for batch in batches:
            for words, before, after in _profiles(batch, of, len(matrix)):
                to, gain = best_classes(after, before, of[words], matrix, movable)
                moves = np.flatnonzero((gain > price) & (words < size))
                yield pa.RecordBatch.from_arrays([pa.array(words[moves].astype(np.int32)), pa.array(to[moves].astype(np.int32))], names=["word", "to"])

    found = rows.mapInArrow(run, "word int, to int").toArrow()  # at most a row per listed word
    shared.destroy()
    return found


def _rounds(rows: DataFrame, symbols: np.ndarray, size: int, movable: int, total: int, rounds: int, price: float):
    """The best classes of ``symbols`` that rounds of exchange find, and their matrix.

    In a round about half of the words move. Where moving so many at once does harm, the round is taken back and a
    quarter as many move in the next.
    """
    matrix = class_matrix(rows, symbols, total)
    best, share = (_fit(matrix), symbols.copy(), matrix), 0.5
    for number in range(rounds):
        found = wanted_moves(rows, symbols, matrix, movable, size, price)
        word, to = found["word"].to_numpy(), found["to"].to_numpy()
        draw = (word.astype(np.int64) * 2654435761 >> 7) + number * 512
        chosen = draw % 1024 < share * 1024
        if len(word) == 0:
            break
        symbols[word[chosen]] = to[chosen]
        matrix = class_matrix(rows, symbols, total)
        if (fit := _fit(matrix)) > best[0]:
            best = (fit, symbols.copy(), matrix)
        elif price > PATIENCE:
            symbols, matrix, share = best[1].copy(), best[2], share / 4
    return best[1], best[2]


def exchange(pairs: DataFrame, vocabulary: Vocabulary, classes: int, rounds: int = ROUNDS, parts: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, and the bigram counts of the classes. Classes from ``classes`` on are forms and the end."""
    size, total = vocabulary.clustered, classes + FORMS + 1
    symbols = np.concatenate([np.arange(size) % max(1, classes), classes + np.arange(FORMS + 1)]).astype(np.int64)
    if size <= 1 or classes <= 1:
        rounds = 0
    return _rounds(neighbours(pairs, parts), symbols, size, classes, total, rounds, 1e-9)


def exchange_all(
    pairs: DataFrame,
    vocabulary: Vocabulary,
    core: int,
    classes: int,
    rounds: int = ROUNDS,
    whole_rounds: int = WHOLE_ROUNDS,
    price: float = PRICE,
    parts: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """As ``exchange`` for any number of words, in ``classes + FORMS`` classes.

    The ``core`` most frequent words are exchanged first, with all others in their forms. Then each form becomes a class
    like any other, in which its words begin, and all words are exchanged; a rare word says little, so a move must gain
    more than ``price``.
    """
    size, movable = vocabulary.clustered, classes + FORMS
    total = movable + FORMS + 1
    core = min(core, size)
    form = forms(vocabulary.words.slice(core, size - core))
    merged = np.concatenate([np.arange(core), core + form, core + np.arange(FORMS + 1)])
    shared, few = pairs.sparkSession.sparkContext.broadcast(merged), min(parts, parts_for(4 * (core + FORMS + 1) ** 2))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            a, b = _parted(_numbers(batch.column(0), "<u8"))
            yield from _dealt(*_summed(_mixed(of[a], of[b]), _numbers(batch.column(1), "<i8")), few)

    # staged, so that no task needs a second Python process to deal the blocks out again
    coarse = staged(_combined(pairs.select("pairs", "counts").mapInArrow(merge, BLOCKS), few), "coarse")
    first, _ = exchange(coarse, Vocabulary(vocabulary.words, vocabulary.counts, core), classes, rounds, few)
    symbols = np.concatenate([first[:core], classes + form, movable + np.arange(FORMS + 1)]).astype(np.int64)
    return _rounds(neighbours(pairs, parts), symbols, size, movable, total, whole_rounds if size > core else 0, price)


@dataclass
class ClassModel:
    vocabulary: Vocabulary
    class_of: np.ndarray  # of symbols
    moves: np.ndarray  # log10 of class after class
    clustered: np.ndarray  # log10 of clustered words in their classes
    form_floor: np.ndarray  # log10 of a form's unseen word
    end: float
    base_floor: float
    tokens: int


def fit(
    texts: DataFrame,
    clustered: int | None = None,
    classes: int | None = None,
    listed: int = LISTED,
    rounds: int = ROUNDS,
    core: int = CORE,
    least: int = LEAST,
    price: float = PRICE,
    whole_rounds: int = WHOLE_ROUNDS,
) -> tuple[ClassModel, DataFrame]:
    """The model of the training texts (one column), and the staged counts of all their words.

    All listed words that occur ``least`` times are clustered, or the ``clustered`` most frequent ones.
    """
    counts = staged(word_counts(texts), "word_counts")
    size = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    tokens, words = size["tokens"] or 0, size["words"]
    known = listed_words(counts, listed)
    frequent = int((known["n"].to_numpy() >= least).sum()) if clustered is None else min(clustered, len(known))
    vocabulary = Vocabulary(plain(known["word"]), known["n"].to_numpy(), frequent)
    classes = class_count(words) if classes is None else classes
    parts = parts_for(tokens)
    pairs = staged(bigrams(texts, vocabulary, parts), "bigrams")
    class_of, matrix = exchange_all(pairs, vocabulary, core, classes, rounds, whole_rounds, price, parts)
    classes += FORMS  # those that began as forms
    n_class = matrix.sum(0)
    share = (n_class + 1) / (n_class.sum() + len(n_class))
    moves = np.log10((matrix + PRIOR * share) / (matrix.sum(1, keepdims=True) + PRIOR))
    own = vocabulary.counts[: vocabulary.clustered].astype(float)
    of_class = np.bincount(class_of[: vocabulary.clustered], own, classes + FORMS + 1)
    inside = np.log10(own / of_class[class_of[: vocabulary.clustered]])
    # a form holds all words that aren't clustered: its tokens are known from the bigrams, its words from the counts
    per_form = _words_per_form(counts, vocabulary)
    floor = -np.log10(n_class[classes : classes + FORMS] + per_form + 1)
    model = ClassModel(vocabulary, class_of, moves, inside, floor, 0.0, -math.log10(tokens + words + 1), tokens)
    return model, counts


def _words_per_form(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How many words outside the clustered ones each form has: all that are counted less the clustered ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(FORMS, np.int64)
        for batch in batches:
            words = plain(batch.column(0))
            sums += np.bincount(forms(words.filter(pc.greater(pc.binary_length(words), 0))), minlength=FORMS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FORMS)), pa.array(sums)], names=["form", "n"])

    out = -np.bincount(forms(vocabulary.words.slice(0, vocabulary.clustered)), minlength=FORMS).astype(float)
    for row in counts.select("word").mapInArrow(run, "form bigint, n bigint").groupBy("form").agg(F.sum("n").alias("n")).collect():
        out[row["form"]] += row["n"]
    return out


SCORED = [
    T.StructField("_tokens", T.LongType()),
    T.StructField("_known", T.LongType()),
    T.StructField("_base", T.DoubleType()),
    T.StructField("_score", T.DoubleType()),
    T.StructField("_rare", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.LongType())]))),
]


def score_slice(model: ClassModel, ends: int, texts: pa.Array) -> list:
    """What is known of each text without the counts of its unlisted words, and those words."""
    size, vocabulary = len(texts), model.vocabulary
    words, rows = split_words(texts, BLANKS)
    place, symbols = vocabulary.symbols(words)
    stream, row_of = with_ends(symbols, rows, size, vocabulary.end)
    classes = model.class_of[stream]
    before = np.concatenate([[model.class_of[vocabulary.end]], classes[:-1]])
    score = np.bincount(row_of, model.moves[before, classes], size)
    listed = place >= 0
    own = listed & (place < vocabulary.clustered)
    log_count = np.zeros(len(words))
    log_count[listed] = np.log10(vocabulary.counts[place[listed]] + 1.0)
    out = np.zeros(len(words))
    out[own] = model.clustered[place[own]]
    out[~own] = model.form_floor[symbols[~own] - vocabulary.clustered] + log_count[~own]
    score += np.bincount(rows, out, size)
    tokens = np.bincount(rows, minlength=size) + 1
    base = np.bincount(rows, log_count, size) + math.log10(ends + 1) + tokens * model.base_floor
    known = np.bincount(rows[listed], minlength=size) + (ends > 0)
    rare = np.flatnonzero(~listed)
    encoded = words.take(pa.array(rare)).dictionary_encode()
    width = max(1, len(encoded.dictionary))
    pairs, times = np.unique(rows[rare] * width + encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
    offsets = np.searchsorted(pairs // width, np.arange(size + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays([encoded.dictionary.take(pa.array(pairs % width)), pa.array(times)], names=["word", "times"])
    return [tokens, known, base, score, pa.ListArray.from_arrays(pa.array(offsets), entries)]


def score(df: DataFrame, learn: Column, text: str = "text", **options) -> DataFrame:
    """All rows of ``df`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Rows for which ``learn`` holds are learned from. Names that start with ``_`` are reserved, result names are replaced.
    """
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    own = [c for c in df.columns if c.lower() not in results and not c.startswith("_")]
    bound_batches(df.sparkSession)
    model, counts = fit(df.filter(learn).select(df[f"`{text}`"].cast("string")), **options)
    ends = counts.filter("word = ''").agg(F.sum("n")).first()[0] or 0
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array, _: pa.RecordBatch) -> list:
        return score_slice(shared.value, ends, texts)

    scored = append_columns(df.select(*[df[f"`{c}`"] for c in own]), text, SCORED, compute)
    passing = [c for c in own if c != text]
    rows = staged(scored.select(F.monotonically_increasing_id().alias("_row"), *[f"`{c}`" for c in passing], *[f.name for f in SCORED]), "scored")
    rare = rows.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.times")
    met = rare.join(counts, "word", "left")
    more = met.groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_seen"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("_logs"),
    )
    logs, seen = F.coalesce("_logs", F.lit(0.0)), F.coalesce("_seen", F.lit(0))
    return rows.join(more, "_row", "left").select(
        *[f"`{c}`" for c in passing],
        F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + seen).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("_base") + logs).alias("base_score"),
        (F.col("_score") + logs).alias("score"),
    )
