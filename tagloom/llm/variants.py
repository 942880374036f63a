"""Group spelling variants: every word of a vocabulary, the words one edit away, and the much more frequent form of it.

Two words of ``m`` and of ``m`` or ``m + 1`` code points that are one edit apart agree in their first ``m // 2`` code
points or in their last ``m - m // 2``. So each word joins up to four groups, named by a length and a half. In a group
the words (turned round where the half is the last one) are sorted, and all of them are matched against that list by
dynamic programming: one banded row of the edit matrix per prefix of the list, worked out once and reused for all words
that share the prefix, which are the neighbours down to where the LCP falls below it. Where a row holds no value up to 1,
the whole range of words behind the prefix is skipped. Each pair is found in exactly one group.

Groups of over ``TILE`` words are cut, in sorted order, into tiles. Tiles whose common prefixes are already further apart
than any two words one edit apart are not compared. A comparison gives one row per word (how many near words, which is
the most frequent), never one per pair.

Null texts have no words, and a null or empty word is none. Words are kept whole at any length; they must not hold U+0000.
Empty tables give empty results. Ties between near words go to the smaller in code point order. Words repeated in the
input count as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.batches import bound_batches
from tagloom.operators.ranking import rank_rows
from tagloom.operators.sizing import small_or_whole, staged

TILE = 4096
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
RUN = "[A-Za-z\\u00C0-\\u00FF]"
#: Code points of the lists that are matched at once, and words that look for near ones in a step.
LIST_CELLS = 1 << 19
QUERIES = 4096
DEAD = 2
GROUP = ["m", "turned", "half"]
TALLY = "word string, n_near bigint, best_n bigint, best string"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def long_runs(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """All maximal runs of letters of at least ``min_length`` code points, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({RUN}{{{min_length},}}+)"), 1)


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words (one column) that are long and frequent enough."""
    (name,) = words.columns
    word = F.col(f"`{name}`").cast("string")
    counts = words.filter(F.length(word) >= min_length).groupBy(word.alias("word")).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _groups(vocabulary: DataFrame, min_length: int) -> DataFrame:
    """``m``, ``turned``, ``half``, ``listed`` (the word as its group sorts it) and ``n``: each word in all its groups."""
    size = F.length("word")
    ways = []
    for shorter in (size, size - 1):
        front = F.floor(shorter / 2).cast("int")
        ways += [F.struct(shorter.alias("m"), F.lit(False).alias("turned"), front.alias("h"))]
        ways += [F.struct(shorter.alias("m"), F.lit(True).alias("turned"), (shorter - front).alias("h"))]
    rows = vocabulary.select("word", "n", F.explode(F.array(*ways)).alias("g")).filter(F.col("g.m") >= min_length)
    listed = F.when(F.col("g.turned"), F.reverse("word")).otherwise(F.col("word"))
    rows = rows.select("g.m", "g.turned", "g.h", listed.alias("listed"), "n")
    return rows.select("m", "turned", F.expr("substring(listed, 1, h)").alias("half"), "listed", "n")


def _code_points(words: list[str], width: int) -> np.ndarray:
    """The words as a matrix of code points, filled up with zeros."""
    return np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width)


def _half(m: int, turned: bool) -> int:
    return m - m // 2 if turned else m // 2


def scan(chars: np.ndarray, listed: np.ndarray, roots: np.ndarray, m: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (query, word) of all pairs one edit apart.

    ``listed`` is a sorted list and ``chars`` the queries, both as code points of words of ``m`` or ``m + 1``. A query
    is matched against the words that share its first ``depth`` code points: ``roots`` numbers that range among all
    ranges of the list that share ``depth`` code points.
    """
    found = [_scan(chars[a : a + QUERIES], listed, roots[a : a + QUERIES], m, depth, a) for a in range(0, len(chars), QUERIES)]
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def common_prefixes(listed: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each word of a sorted list with the word before; 0 for the first."""
    differ = listed[1:] != listed[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), listed.shape[1])
    return np.concatenate([[0], lcp])


def _scan(chars, listed, roots, m, depth, base):
    lcp = common_prefixes(listed)
    lcp[0] = -1
    lengths = m + (chars[:, m] != 0)
    ends = m + (listed[:, m] != 0)
    padded = np.zeros((len(chars), m + 4), np.uint32)
    padded[:, 1 : m + 2] = chars  # code point number j, counted from 1, stands in column j
    firsts = np.flatnonzero(lcp < depth)  # first word of each range that shares ``depth`` code points
    query, node = np.arange(len(chars)), roots
    # cells (d, d - 1), (d, d), (d, d + 1) of the edit matrix of a prefix of d code points; DEAD stands for more, too
    band = np.repeat(np.array([[1], [0], [1]], np.int8), len(chars), axis=1)
    hits_q, hits_w = [], []
    for d in range(depth, m + 2):
        if d >= m:
            word = firsts[node]
            column = lengths[query] - d + 1
            hit = np.flatnonzero((ends[word] == d) & (column >= 0) & (column <= 2))
            hit = hit[band[column[hit], hit] == 1]
            hits_q.append(query[hit])
            hits_w.append(word[hit])
        if d == m + 1 or len(query) == 0:
            break
        below = np.flatnonzero(lcp < d + 1)
        begin = np.searchsorted(below, firsts)  # ranges of the next depth, by the range they lie in
        fan = np.append(begin[1:], len(below))[node] - begin[node]
        parent = np.repeat(np.arange(len(query)), fan)
        child = np.repeat(begin[node] - (np.cumsum(fan) - fan), fan) + np.arange(len(parent))
        letter = listed[below[child], d]
        query = query[parent]
        o0, o1, o2 = band[:, parent]
        n0 = np.minimum(o0 + (letter != padded[query, d]), o1 + 1) if d else o1 + 1
        n1 = np.minimum(np.minimum(o1 + (letter != padded[query, d + 1]), o2 + 1), n0 + 1)
        n2 = np.minimum(o2 + (letter != padded[query, d + 2]), n1 + 1)
        band = np.minimum(np.stack([n0, n1, n2]), DEAD).astype(np.int8)
        alive = (band.min(axis=0) < DEAD) & (letter != 0)
        query, node, band = query[alive], child[alive], band[:, alive]
        firsts = below
    if not hits_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hits_q) + base, np.concatenate(hits_w)


def _own_pairs(q, w, chars, listed, m: int, turned: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no other group finds as well."""
    x, y = chars[q], listed[w]
    keep = (x[:, m] == 0) | (y[:, m] == 0)  # two words of m + 1 meet in the groups of m + 1
    if turned:  # words that agree in the other half, too, meet in its group
        back = np.arange(1, m // 2 + 1)
        at = np.arange(len(q))[:, None]
        x_end, y_end = (m + (v[:, m] != 0)[:, None] - back for v in (x, y))
        keep &= (x[at, x_end] != y[at, y_end]).any(axis=1)
    return q[keep], w[keep]


def _tally(from_, to, words: np.ndarray, n: np.ndarray, turned: bool) -> pa.RecordBatch:
    """One row per word that has near ones: how many, and the most frequent of them."""
    if len(from_) == 0:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())], names=_TALLY_NAMES)
    used, place = np.unique(np.concatenate([from_, to]), return_inverse=True)
    a, b = place[: len(from_)], place[len(from_) :]
    plain = np.array([words[i][::-1] if turned else words[i] for i in used], dtype=object)
    rank = np.empty(len(used), np.int64)
    rank[sorted(range(len(used)), key=plain.__getitem__)] = np.arange(len(used))
    order = np.lexsort((rank[b], -n[used[b]], a))
    own, first, near = np.unique(a[order], return_index=True, return_counts=True)
    best = b[order][first]
    return pa.RecordBatch.from_arrays(
        [pa.array(plain[own].tolist(), pa.string()), pa.array(near, pa.int64()), pa.array(n[used[best]], pa.int64()), pa.array(plain[best].tolist(), pa.string())],
        names=_TALLY_NAMES,
    )


_TALLY_NAMES = ["word", "n_near", "best_n", "best"]


def _match_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (m, turned, listed), all of a group in one task, matched list by list."""

    def lists():
        kind, words, counts, half = None, [], [], None
        for batch in batches:
            for m, turned, lead, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (m, turned) != kind or (lead != half and len(words) * (m + 1) > LIST_CELLS):
                    if len(words) > 1:
                        yield *kind, words, counts
                    kind, words, counts = (m, turned), [], []
                half = lead
                words.append(word)
                counts.append(n)
        if len(words) > 1:
            yield *kind, words, counts

    for m, turned, words, counts in lists():
        depth = _half(m, turned)
        chars = _code_points(words, m + 1)
        roots = np.cumsum(common_prefixes(chars) < depth) - 1 if depth else np.zeros(len(chars), np.int64)
        q, w = scan(chars, chars, roots, m, depth)
        yield _tally(*_own_pairs(q, w, chars, chars, m, turned), words, np.array(counts), turned)


def _match_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row two tiles of a group, or one and null."""
    for batch in batches:
        for m, turned, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            depth = _half(m, turned)
            words = [v["listed"] for v in a]
            counts = np.array([v["n"] for v in a + (b or [])])
            chars = _code_points(words, m + 1)
            other = chars if b is None else _code_points([v["listed"] for v in b], m + 1)
            q, w = _own_pairs(*scan(chars, other, np.zeros(len(chars), np.int64), m, depth), chars, other, m, turned)
            if b is not None:
                words += [v["listed"] for v in b]
                q, w = np.concatenate([q, w + len(chars)]), np.concatenate([w + len(chars), q])
            yield _tally(q, w, words, counts, turned)


def _tile_pairs(members: DataFrame, tile: int) -> DataFrame:
    """``m``, ``turned`` and the tiles ``a``, ``b`` of large groups that may hold words one edit apart.

    Equally long prefixes of two words one edit apart are at most two edits apart; tiles are skipped by that.
    """
    ranked = rank_rows(members, GROUP, [F.col("listed")], "_rank")
    cut = ranked.withColumn("tile", F.floor((F.col("_rank") - 1) / F.lit(tile)))
    tiles = cut.groupBy(*GROUP, "tile").agg(F.sort_array(F.collect_list(F.struct("listed", "n"))).alias("members"))
    tiles = staged(tiles, "spelling_tiles")
    ends = tiles.select(*GROUP, "tile", F.col("members")[0]["listed"].alias("low"), F.element_at("members", -1)["listed"].alias("high"))
    differs = F.filter(F.sequence(F.lit(1), F.col("m") + 1), lambda i: F.substring("low", i, F.lit(1)) != F.substring("high", i, F.lit(1)))
    leads = ends.withColumn("_common", F.coalesce(F.get(differs, F.lit(0)) - 1, F.col("m")))
    leads = leads.select(*GROUP, "tile", F.expr("substring(low, 1, _common)").alias("lead"))
    visitors = leads.select(*GROUP, F.col("tile").alias("other"), F.col("lead").alias("other_lead"))
    shared = F.least(F.length("lead"), F.length("other_lead"))
    apart = F.levenshtein(F.substring("lead", F.lit(1), shared), F.substring("other_lead", F.lit(1), shared))
    met = leads.join(visitors, GROUP).filter((F.col("tile") <= F.col("other")) & (apart <= 2)).select(*GROUP, "tile", "other")
    first = met.join(tiles.withColumnRenamed("members", "a"), [*GROUP, "tile"])
    second = tiles.select(*GROUP, F.col("tile").alias("other"), F.col("members").alias("b"))
    return first.join(second, [*GROUP, "other"]).select("m", "turned", "a", F.when(F.col("tile") != F.col("other"), F.col("b")).alias("b"))


def near_words(vocabulary: DataFrame, min_length: int = 1, tile: int = TILE) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` of each word of ``vocabulary`` (``word``, ``n``) that has near ones.

    ``vocabulary`` must be a stored table or cheap to read again, with each word once and none below ``min_length``.
    """
    bound_batches(vocabulary.sparkSession)
    rows = _groups(vocabulary.filter(F.length("word") > 0), max(1, min_length))
    sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("size"))
    large = staged(sizes.filter(F.col("size") > tile).drop("size"), "spelling_large")
    cut = not large.isEmpty()
    fitting = rows.join(small_or_whole(large), GROUP, "left_anti") if cut else rows
    order = ["m", "turned", "listed"]
    placed = fitting.repartition(*GROUP).sortWithinPartitions(*order).select("m", "turned", "half", "listed", "n")
    found = placed.mapInArrow(_match_lists, TALLY)
    if cut:
        members = rows.join(small_or_whole(large), GROUP, "left_semi")
        found = found.unionByName(_tile_pairs(members, tile).mapInArrow(_match_tiles, TALLY))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return near.select("word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of the chain that starts with ``form``; each round doubles the steps taken.

    A form is at least ``ratio`` times as frequent as its word, so chains are short and have no cycles.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots
        jumped = roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = staged(jumped, "spelling_roots")


def variants(vocabulary: DataFrame, ratio: int = RATIO, min_length: int = 1, tile: int = TILE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each word of ``vocabulary`` (``word``, ``n``).

    A word's form is its most frequent near word, if that is at least ``ratio`` (above 1) times as frequent.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or words could be each other's forms")
    words = staged(vocabulary.select("word", "n"), "vocabulary")
    near = near_words(words, min_length, tile)
    follows = F.col("best_n") >= F.col("n") * ratio
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, F.col("best")).alias("form"),
        F.when(follows, F.col("best_n")).alias("form_n"),
    )
    judged = staged(judged, "spelling_forms")
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def normalised(df: DataFrame, found: DataFrame, word: str = "word") -> DataFrame:
    """``df`` with the roots of ``variants`` in place of its words; a word the vocabulary lacks stays."""
    roots = found.filter("root <> word").select(F.col("word").alias("_variant"), F.col("root").alias("_root"))
    own = [F.coalesce("_root", F.col(f"`{word}`")).alias(word) if c == word else df[f"`{c}`"] for c in df.columns]
    return df.join(small_or_whole(roots), df[f"`{word}`"] == F.col("_variant"), "left").select(*own)
