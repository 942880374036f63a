"""Toxicity scores from a learned lexicon, found in texts despite misspellings.

1. Words that labelled toxic texts hold far more often than others (log-likelihood ratio) become the lexicon.
   Words of any length can, and all that pass the test do. Up to 3 letters, and beyond ``MAX_LETTERS``, they count as
   written only; the latter go by their digests. Scripts written without blanks give grams of two and three letters.
2. Every distinct word of a batch runs through the product of the lexicon's trie and its Levenshtein automaton. The
   product is made deterministic state by state, as words ask for it, and numpy moves all words one character at a
   time; most fall out after a few. When the states fill ``TABLE_BYTES``, all that no word stands in are forgotten.
3. Each hit is read in a window of its text: quotation marks around it and words of reporting tell a quotation, words
   of address and exclamation marks tell abuse.
4. A logistic regression over counts, weights and contexts of the hits gives the score.

Null texts count as empty. A text without words or hits gets the score of such texts. Without labelled rows of both
kinds every score is the share of toxic ones, zero without any. Rows are never dropped.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import ALNUM, BLANKS, append_columns, bound_batches, forget, kept_by_worker, plain, row_slices, split_words
from tagloom.llm.decontaminate import WORD

#: Labelled rows the model is fitted on at most, those whose keys hash lowest.
MAX_LABELLED = 100_000
#: Terms of one automaton; a lexicon has as many automata as it needs.
TOGETHER = 400
MIN_DOCUMENTS = 3
#: Longest word that counts with misspellings.
MAX_LETTERS = 64
#: Memory for the moves of all automata of a model, beyond which states are forgotten.
TABLE_BYTES = 64 << 20
GRAMS = (2, 3)
WINDOW, REACH = 5, 60
# fixed values: marks and words that tell the contexts of a hit
OPENING, CLOSING = '"“„«‘', '"”“»’'
MARKS = "“”„«»‘’‚‹›…–—¡¿"
REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quotes word term phrase sagte schrieb nannte wort dit disait écrit mot "
    "dijo dice escribió palabra".split()
)
# fixed values: blocks of Thai, Lao, Myanmar, Khmer, kana and Han, whose words no blank parts
BORDERLESS = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]+"
BORDERLESS_RUN = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), BORDERLESS))
ADDRESS = frozenset("you your youre u ur du dich dein deine ihr euch tu te toi ton vous votre tú usted ustedes".split())


def lexical_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without the typographic marks that stick to them, and their rows.

    Words in scripts without blanks are replaced by their grams, each once for every such word, and what lies between.
    """
    words, rows = split_words(texts, ALNUM)
    words = pc.utf8_trim(words, MARKS)
    # in UTF-8 these scripts need a byte beyond 0xDF, other than that of punctuation
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    if not ((data > 0xDF) & (data != 0xE2)).any():
        return words, rows
    cut = pc.match_substring_regex(words, BORDERLESS).to_numpy(zero_copy_only=False)
    grams = [_grams(w) for w in words.filter(pa.array(cut)).to_pylist()]
    of_grams = np.repeat(rows[cut], [len(g) for g in grams])
    every = pa.concat_arrays([words.filter(pa.array(~cut)), pa.array([g for own in grams for g in own], pa.string())])
    owners = np.concatenate([rows[~cut], of_grams])
    order = np.argsort(owners, kind="stable")
    return every.take(pa.array(order)), owners[order]


def _grams(word: str) -> list[str]:
    out = {part.strip(MARKS) for part in BORDERLESS_RUN.split(word)} - {""}
    for run in BORDERLESS_RUN.findall(word):
        for n in GRAMS:
            out.update(run[k : k + n] for k in range(len(run) - n + 1))
        if len(run) < min(GRAMS):
            out.add(run)
    return sorted(out)


def named(words: pa.Array) -> pa.Array:
    """Words as the lexicon names them: those beyond ``MAX_LETTERS`` by a mark no word holds and their SHA-256."""
    long = pc.greater(pc.utf8_length(words), MAX_LETTERS)
    if not pc.any(long).as_py():
        return words
    names = ["\0" + hashlib.sha256(w.encode()).hexdigest() for w in words.filter(long).to_pylist()]
    return pc.replace_with_mask(words, long, pa.array(names, pa.string()))


def allowed_edits(letters: int) -> int:
    return 0 if letters <= 3 or letters > MAX_LETTERS else 1 if letters <= 8 else 2


def _packed(nodes: dict[int, int]) -> bytes:
    return array("i", sorted(4 * node + edits for node, edits in nodes.items())).tobytes()


class LexiconAutomaton:
    """Finds the nearest term of a lexicon for words within the edits their length allows."""

    DEAD, UNKNOWN = 0, -1

    def __init__(self, terms: list[str], weights: list[float], table_bytes: int = TABLE_BYTES):
        self.terms, self.weights = terms, weights
        self.children: list[dict[str, int]] = [{}]
        self.term_at: dict[int, int] = {}
        self.reach = [0]  # most edits that any term below the node allows
        for number, term in enumerate(terms):
            node, edits = 0, allowed_edits(len(term))
            self.reach[0] = max(self.reach[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], edits)
            self.term_at[node] = number
        letters = sorted({x for t in terms for x in t})
        self.letters = letters
        self.code_points = np.array([ord(x) for x in letters], np.uint32)
        self.longest = max((len(t) + allowed_edits(len(t)) for t in terms), default=0)
        start = self._closed({0: 0})
        # a state is the sorted numbers 4 * node + edits, packed: there may be tens of thousands of states
        self.states: list[bytes] = [b"", _packed(start)]
        self.numbers = {state: number for number, state in enumerate(self.states)}
        self.moves = np.full((64, len(letters) + 1), self.UNKNOWN, np.int32)
        self.moves[0] = self.DEAD
        self.ends = np.zeros((64, 2), np.int64)
        self.ends[:2] = (-1, 0), self._end(start)
        self.grant(table_bytes)

    @property
    def held(self) -> int:
        """Bytes of the moves in use."""
        return 4 * len(self.states) * self.moves.shape[1]

    def grant(self, table_bytes: int) -> None:
        """Bound the moves. Words of a block stand in half of the states at most, so forgetting always makes room."""
        self.most_states = max(128, table_bytes // (4 * self.moves.shape[1]))
        self.block = self.most_states // 2

    def _forget(self, standing: np.ndarray) -> np.ndarray:
        """Keep the states of ``standing``, and the first ones, which common beginnings lead to; returns new numbers."""
        first = min(len(self.states), max(2, self.most_states // 4))
        keep = np.unique(np.concatenate([np.arange(first), standing]))
        number = np.full(len(self.moves) + 1, self.UNKNOWN, np.int32)  # the last is for UNKNOWN itself
        number[keep] = np.arange(len(keep))
        self.states = [self.states[s] for s in keep]
        self.numbers = {state: k for k, state in enumerate(self.states)}
        self.moves, self.ends = number[self.moves[keep]], self.ends[keep]
        return number[standing].astype(np.int64)

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes that skipped letters of terms lead to."""
        out, stack = {}, list(nodes.items())
        while stack:
            node, edits = stack.pop()
            if edits > self.reach[node] or out.get(node, 99) <= edits:
                continue
            out[node] = edits
            stack.extend((child, edits + 1) for child in self.children[node].values())
        return out

    def _end(self, nodes: dict[int, int]) -> tuple[int, int]:
        """Best term that ends here, and its edits."""
        fits = [
            (edits, -self.weights[t], t)
            for node, edits in nodes.items()
            if (t := self.term_at.get(node)) is not None and edits <= allowed_edits(len(self.terms[t]))
        ]
        return (min(fits)[2], min(fits)[0]) if fits else (-1, 0)

    def _move(self, state: int, letter: int) -> int:
        text = self.letters[letter - 1] if letter else None
        reached: dict[int, int] = {}
        for number in array("i", self.states[state]):
            node, edits = number >> 2, number & 3
            for to, cost in ((node, edits + 1), *((c, edits + (x != text)) for x, c in self.children[node].items())):
                if cost <= self.reach[to] and cost < reached.get(to, 99):
                    reached[to] = cost
        closed = self._closed(reached)
        key = _packed(closed)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            if len(self.states) > len(self.moves):
                more = max(64, len(self.moves) // 2)
                self.moves = np.pad(self.moves, ((0, more), (0, 0)), constant_values=self.UNKNOWN)
                self.ends = np.pad(self.ends, ((0, more), (0, 0)))
            self.ends[len(self.states) - 1] = self._end(closed)
        return self.numbers[key]

    def match(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word the number of its nearest term, or -1, and the edits between them."""
        term, edits = np.full(len(words), -1), np.zeros(len(words), np.int64)
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.flatnonzero((sizes > 0) & (sizes <= self.longest))
        if self.terms:
            for start in range(0, len(rows), self.block):
                part = rows[start : start + self.block]
                ends = self._match_block(words.take(pa.array(part)), sizes[part])
                term[part], edits[part] = ends[:, 0], ends[:, 1]
        return term, edits

    def _match_block(self, words: pa.Array, sizes: np.ndarray) -> np.ndarray:
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.code_points, points), len(self.code_points) - 1)
        letters = np.where(self.code_points[place] == points, place + 1, 0)
        starts = np.cumsum(sizes) - sizes
        found = np.full((len(words), 2), (-1, 0), np.int64)
        state = np.ones(len(words), np.int64)
        alive = np.arange(len(words))
        for k in range(self.longest + 1):
            done = sizes[alive] == k
            found[alive[done]] = self.ends[state[alive[done]]]
            alive = alive[~done]
            if len(alive) == 0:
                break
            if len(self.states) > self.most_states:
                state[alive] = self._forget(state[alive])
            now, letter = state[alive], letters[starts[alive] + k]
            after = self.moves[now, letter]
            if (after == self.UNKNOWN).any():
                asked = np.unique(np.stack([now, letter])[:, after == self.UNKNOWN], axis=1).T.tolist()
                for s, x in asked:
                    to = self._move(s, x)
                    self.moves[s, x] = to
                after = self.moves[now, letter]
            state[alive] = after
            alive = alive[after != self.DEAD]
        return found


@kept_by_worker(maxsize=1)
def _automata(terms: tuple[str, ...], weights: tuple[float, ...], size: int) -> list[LexiconAutomaton]:
    """Those of a lexicon, once per worker: fitting and scoring share the states they have made, other operators drop them."""
    return [LexiconAutomaton([*terms[k : k + size]], [*weights[k : k + size]]) for k in range(0, len(terms), size)]


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: list[float]
    coefficients: list[float] = field(default_factory=list)
    intercept: float = -math.inf
    _automata: list[LexiconAutomaton] | None = None

    def match(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word the number of its nearest term, or -1, and the edits between them; of equals the heaviest, then the first."""
        if self._automata is None:
            self._automata = _automata(tuple(self.terms), tuple(self.weights), TOGETHER)
        words = named(words)
        term, edits = np.full(len(words), -1), np.zeros(len(words), np.int64)
        weights = np.array([*self.weights, -np.inf])  # the last is for no term
        for number, automaton in enumerate(self._automata):
            others = sum(a.held for a in self._automata) - automaton.held
            automaton.grant(max(TABLE_BYTES - others, TABLE_BYTES // len(self._automata)))
            own, own_edits = automaton.match(words)
            own = np.where(own >= 0, own + number * TOGETHER, -1)
            nearer = (term < 0) | (own_edits < edits) | ((own_edits == edits) & (weights[own] > weights[term]))
            better = (own >= 0) & nearer
            term, edits = np.where(better, own, term), np.where(better, own_edits, edits)
        return term, edits

    def __getstate__(self):
        return {**self.__dict__, "_automata": None}


def _quoted(left: str, right: str) -> bool:
    """Whether a quotation is open on the left and closes on the right."""
    return any(
        left.count(o) % 2 if o == c else left.rfind(o) > left.rfind(c)
        for o, c in zip(OPENING, CLOSING, strict=True)
        if o in left and c in right
    )


def _stands_alone(text: str, start: int, stop: int) -> bool:
    """Whether a word begins and ends here, but for typographic marks that stick to it."""
    while start and text[start - 1] in MARKS:
        start -= 1
    while stop < len(text) and text[stop] in MARKS:
        stop += 1
    return not (start and WORD.match(text[start - 1])) and not (stop < len(text) and WORD.match(text[stop]))


def contexts(text: str, found: dict[str, tuple[int, int]]) -> list[tuple[int, int, bool, bool]]:
    """Term, edits, whether quoted, whether aimed at someone, of each hit of ``found`` in ``text``.

    A context is up to ``WINDOW`` words within ``REACH`` characters on either side; only hits are looked at.
    """
    lowered = text.encode().translate(BLANKS).decode()
    out = []
    for word, hit in found.items():
        borderless = bool(BORDERLESS_RUN.fullmatch(word))
        start = lowered.find(word)
        while start >= 0:
            stop = start + len(word)
            if borderless or _stands_alone(lowered, start, stop):
                left, right = lowered[max(0, start - REACH) : start], lowered[stop : stop + REACH]
                near = {w.strip(MARKS) for w in WORD.findall(left)[-WINDOW:] + WORD.findall(right)[:WINDOW]}
                quoted = _quoted(left, right) or bool(near & REPORTING)
                aimed = bool(near & ADDRESS) or "!" in right[:20]
                out.append((*hit, quoted, aimed))
            start = lowered.find(word, start + 1)
    return out


N_FEATURES = 8
#: What a hit counts for each edit it is away from its term.
NEAR = 0.8


def features(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text of a slice."""
    words, rows = lexical_words(texts)
    out = np.zeros((len(texts), N_FEATURES))
    n_words = np.bincount(rows, minlength=len(texts))
    out[:, 0] = np.log1p(n_words)
    encoded = words.dictionary_encode()
    term, edits = model.match(encoded.dictionary)
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    hits = np.flatnonzero(term[codes] >= 0) if len(words) else np.zeros(0, np.int64)
    names = encoded.dictionary.to_pylist() if len(hits) else []
    bounds = np.searchsorted(rows[hits], np.arange(len(texts) + 1))
    for row in np.unique(rows[hits]).tolist():
        own = np.unique(codes[hits[bounds[row] : bounds[row + 1]]]).tolist()
        found = {names[c]: (int(term[c]), int(edits[c])) for c in own}
        read = contexts(texts[row].as_py(), found)
        own = [(model.weights[t] * NEAR**e, t, e, aimed) for t, e, quoted, aimed in read if not quoted]
        out[row, 1:] = (
            math.log1p(sum(NEAR**e for _, _, e, _ in own)),
            math.log1p(sum(e > 0 for _, _, e, _ in own)),
            math.log1p(len(read) - len(own)),
            max((w for w, *_ in own), default=0.0),
            10 * len(own) / max(1, n_words[row]),
            math.log1p(sum(aimed for *_, aimed in own)),
            math.log1p(len({t for _, t, *_ in own})),
        )
    return out


def _word_counts(labelled: DataFrame) -> DataFrame:
    """Documents and toxic documents that hold a word, combined per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = plain(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, stop in row_slices(texts, 16 << 20):
                words, rows = lexical_words(texts.slice(start, stop - start))
                encoded = named(words).dictionary_encode()
                size = len(encoded.dictionary)
                if not size:
                    continue
                codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                pairs = np.unique(rows * size + codes)
                code, bad = pairs % size, toxic[start + pairs // size]
                counts = [np.bincount(code, minlength=size), np.bincount(code, bad, size).astype(np.int64)]
                columns = [encoded.dictionary, *map(pa.array, counts)]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "bad"])

    rows = labelled.mapInArrow(count, "word string, n bigint, bad bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _xlogx(x: Column, of: Column) -> Column:
    return F.when(x > 0, x * F.log(x / of)).otherwise(0.0)


def learn_lexicon(labelled: DataFrame, total: int, toxic: int) -> tuple[list[str], list[float]]:
    """Words bound to the label by a log-likelihood ratio beyond what chance gives among so many words."""
    counts = _word_counts(labelled).filter(F.col("n") >= MIN_DOCUMENTS)
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    share = toxic / total
    rest_n, rest_bad = F.lit(float(total)) - n, F.lit(float(toxic)) - bad
    llr = 2 * (
        _xlogx(bad, n * share)
        + _xlogx(n - bad, n * (1 - share))
        + _xlogx(rest_bad, rest_n * share)
        + _xlogx(rest_n - rest_bad, rest_n * (1 - share))
    )
    weight = F.log((bad + 0.5) / (n - bad + 0.5)) - math.log(share / (1 - share))
    rated = counts.select("word", "n", llr.alias("llr"), weight.alias("weight"), (bad / n).alias("share"))
    sized = counts.agg(F.count("*").alias("v")).first()["v"]
    bound = 2 * math.log(max(sized, 1)) + 4
    chosen = rated.filter((F.col("llr") >= bound) & (F.col("share") >= max(0.5, 2 * share)))
    best = chosen.orderBy(F.desc("llr"), "word").collect()
    return [r["word"] for r in best], [float(r["weight"]) for r in best]


def fit(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> ToxicityModel:
    """A model from the rows of ``df`` that ``labels`` marks 0 or 1; of several marks of a key the highest counts."""
    bound_batches(df.sparkSession)
    marks = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    marks = marks.dropna().filter("_label in (0, 1)").groupBy("_key").agg(F.max("_label").alias("_label"))
    sample = marks.orderBy(F.xxhash64("_key"), "_key").limit(max_labelled)
    labelled = df.join(F.broadcast(sample), df[f"`{key}`"] == F.col("_key")).select(
        df[f"`{text}`"].cast("string").alias("text"), "_label"
    )
    size = labelled.agg(F.count("*").alias("n"), F.sum("_label").alias("bad")).first()
    total, toxic = size["n"], size["bad"] or 0
    if toxic in (0, total):
        share = toxic / total if total else 0.0
        return ToxicityModel([], [], [0.0] * N_FEATURES, math.inf if share else -math.inf)
    model = ToxicityModel(*learn_lexicon(labelled, total, toxic))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array, _: pa.RecordBatch) -> list:
        return [list(features(shared.value, texts))]

    rows = append_columns(labelled, "text", [T.StructField("x", T.ArrayType(T.DoubleType()))], compute, _automata)
    training = rows.select(array_to_vector("x").alias("features"), F.col("_label").cast("double").alias("label")).cache()
    fitted = LogisticRegression(maxIter=50, regParam=1e-3).fit(training)
    training.unpersist()
    model.coefficients, model.intercept = [float(c) for c in fitted.coefficients], float(fitted.intercept)
    return model


def score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``df`` with ``score`` between 0 and 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array, _: pa.RecordBatch) -> list:
        known = shared.value
        margin = features(known, texts) @ np.array(known.coefficients) + known.intercept
        with np.errstate(over="ignore"):
            return [1 / (1 + np.exp(-margin))]

    return append_columns(df, text, [T.StructField("score", T.DoubleType())], compute, _automata)
