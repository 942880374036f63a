"""Personal data: fixed patterns, and boosted trees over candidates that the patterns miss.

* Base spans match the fixed pattern of a kind and its check; they always count.
* Generators with high recall propose more spans of each kind, which may overlap: every stretch of neighbouring digit
  groups that is as long as the kind allows, also within longer runs, spelled-out addresses, quads of numbers in any
  writing, IPv6 addresses. Each candidate gets numbers for its format and its context.
* Gradient-boosted trees learn to tell base spans from proposals with evidence against them (inside an identifier, a
  check digit or a number out of range, a stretch that cuts a base span). They see format, borders, words nearby and the
  check of the kind, and of each base span also forms that its pattern would refuse: a phone without its country, an
  address spelled out, a number beside another one. Proposals with no evidence either way aren't learned from; the
  trees score all proposals, also those with evidence against them.
* Thresholds are calibrated per kind on candidates kept from training, one in five: the lowest score from which on
  ``PRECISION`` of the candidates are right. Of overlapping proposals the one with the highest score is taken; none overlaps a base
  span.

Spans are code points, end exclusive. Null texts count as empty. Trees and thresholds come from all candidates
whose label is known; those described alike are counted before they are staged, and weigh as many. Spark itself looks at
some rows only where it bins a number into ``maxBins``. Without candidates of both sorts there are only base spans. Every scan takes time in
proportion to its text, also on long runs of digits or signs. Texts are read twice, to learn and to choose, so that no
table of candidates is kept.
"""

from __future__ import annotations

import bisect
import ipaddress
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields, replace
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import bound_batches, plain
from tagloom.operators.sizing import staged, staging_path

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
#: Kinds of candidates in one partition of the training rows, and bins of scores that thresholds are looked for in.
PART_ROWS, SCORE_BINS = 20_000, 1024
TREES, DEPTH = 12, 4
CONTEXT = 24
#: Candidates described or scored together.
AT_ONCE = 1 << 15

# fixed values: the patterns of base spans, in forms that take linear time
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# generators
LEAST_DIGITS, MOST_DIGITS = 7, 19
#: Digits a proposed card or phone has.
FITTING = {2: (12, 19), 3: (7, 15)}
#: Texts with more digit groups than ``FEW`` are looked at by columns, ``BLOCK`` groups at once.
FEW, BLOCK = 128, 4096
_SEPARATORS = " .-("
_GROUP = re.compile("[0-9]+")
_JOINED_BEFORE, _JOINED_AFTER = re.compile(r"[0-9][ ().\-/]{0,3}$"), re.compile(r"[ ().\-/]{0,3}[0-9]")
_RUN = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,3}[0-9])+")
_SPELLED = re.compile(
    r"(?<![\w.+-])[\w.+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}| at ) ?[\w-]{1,64}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[a-z0-9-]{2,64}){1,4}",
    re.IGNORECASE,
)
_QUAD = re.compile(
    r"(?<![0-9.])[0-9]{1,3}(?: {0,2}(?:\[\.\]|\(\.\)|\{\.\}|\[dot\]|\(dot\)|\{dot\}|dot|\.) {0,2}[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE
)
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:[0-9]{1,3}\.){3}[0-9]{1,3}|[0-9A-Fa-f]{1,4})?(?![\w:])")
_SENTENCE = re.compile(r"(?<! )\. | \.(?! )")
_ANCHOR = re.compile(r"\(at\)|\[at\]|\{at\}| at (?=[\w-]{1,64}(?:\.| dot |\(dot\)|\[dot\]))", re.IGNORECASE)
# fixed values: words near a span that speak for a kind
_CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr", "ping"),
    "card": ("card", "visa", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobil", "anruf"),
}
SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
#: Role 0: base span, 1: proposal, 2: form of a base span to learn from. Label 1 or 0, null where nothing tells.
CANDIDATE = T.StructType(
    [*SPAN, T.StructField("role", T.IntegerType()), T.StructField("label", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))]
)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[0::2]) % 10 == sum(sum(divmod(2 * v, 10)) for v in values[1::2]) * 9 % 10


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern; each one is found from its ``@``."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    return out


def quads(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of four numbers joined by dots."""
    out = []
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, numbers = run.start(), []
        for part in run.group().split("."):
            numbers = [*numbers, (at, at + len(part))] if part else []
            if len(numbers) == 4:
                out.append((numbers[0][0], numbers[3][1]))
                numbers = []
            at += len(part) + 1
    return out


def out_of_range(quad: str) -> bool:
    """Whether some part of a quad is over 255, however many zeros it begins with."""
    return any(len(p) > 3 or int(p or "0") > 255 for p in (part.lstrip("0") for part in quad.split(".")))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and stop of all base spans, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, a, b) for a, b in quads(text) if not out_of_range(text[a:b])]
    for kind, pattern, least, most in ((2, _CARD, 13, 19), (3, _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = _digits(m.group())
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def written_out(text: str) -> list[tuple[int, int, int]]:
    """Candidate spans of addresses and quads; they may overlap."""
    found_quads = [*quads(text), *(m.span() for m in _QUAD.finditer(text)), *(m.span() for m in _IPV6.finditer(text) if m.group().strip(":"))]
    out = [(1, a, b) for a, b in sorted(set(found_quads))]
    last = 0
    for m in _ANCHOR.finditer(text):
        left = max(last, m.start() - 66)
        found = _SPELLED.search(text, left, min(len(text), m.end() + 400))
        if found and found.start() < m.end():
            out.append((0, *found.span()))
            last = found.end()
    return out


def digit_groups(text: str) -> tuple[list[tuple[int, int]], list[int]]:
    """Spans of the digit groups of all runs that could hold a number, and the run of each."""
    groups, runs = [], []
    for number, run in enumerate(_RUN.finditer(text)):
        if run.end() - run.start() >= LEAST_DIGITS:
            own = [g.span() for g in _GROUP.finditer(text, run.start(), run.end())]
            groups += own
            runs += [number] * len(own)
    return groups, runs


def windows(text: str, groups: list[tuple[int, int]], runs: list[int]) -> list[tuple[int, int, int]]:
    """Phones and cards: every stretch of neighbouring groups of a run whose digits fit the kind."""
    out = []
    for i, (start, _) in enumerate(groups):
        digits = 0
        for j in range(i, len(groups)):
            digits += groups[j][1] - groups[j][0]
            if runs[j] != runs[i] or digits > MOST_DIGITS:
                break
            for kind, (least, most) in FITTING.items():
                if least <= digits <= most:
                    signed = kind == 3 and start > 0 and text[start - 1] in "+("
                    out.append((kind, start - signed, groups[j][1]))
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Candidate spans of all kinds; they may overlap."""
    return written_out(text) + windows(text, *digit_groups(text))


N_FEATURES = 27


def checked(kind: int, body: str) -> bool:
    """Whether a span passes what its kind can be checked for.

    A phone should be more than bare digits, and an address should not run over the end of a sentence.
    """
    if kind == 1:
        if ":" not in body:
            return not out_of_range(".".join(_GROUP.findall(body)))
        try:
            return bool(ipaddress.IPv6Address(body))
        except ValueError:
            return False
    if kind == 2:
        return luhn(_digits(body))
    return _SENTENCE.search(body) is None if kind == 0 else not body.isdigit()


def describe(kind: int, left: str, body: str, right: str) -> list[float]:
    """Format, context and check of a candidate as numbers."""
    groups = [len(g) for g in re.findall("[0-9]+", body)]
    near = (left + " " + right).lower()
    before, after = left[-1:], right[:1]
    digits = _digits(body)
    return [
        *(float(kind == k) for k in range(4)),
        float(len(body)),
        float(len(digits)),
        float(len(groups)),
        float(max(groups, default=0)),
        float(min(groups, default=0)),
        float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0),
        float(len(set(digits))),
        float(sum(c.isalpha() for c in body)),
        float(before.isalpha() or before == "_"),
        float(after.isalpha() or after == "_"),
        float(before.isdigit() or after.isdigit()),
        float(before in "=\"'#/" and before != ""),
        float(after in "\"'/%" and after != ""),
        float(any(c in near for c in _CUES[KINDS[kind]])),
        float(any(c in near for k, cues in _CUES.items() if k != KINDS[kind] for c in cues)),
        float(_JOINED_BEFORE.search(left + (body[:1] if body[:1] in "+(" else "")) is not None),
        float(_JOINED_AFTER.match(right) is not None),
        *(float(body.count(c)) for c in _SEPARATORS),
        float(not refuted(kind, left, body, right)),
    ]


def refuted(kind: int, left: str, body: str, right: str) -> bool:
    """Whether something speaks against a proposal: it is part of an identifier, or a check of its kind fails."""
    before, after = left[-1:], right[:1]
    return before.isalnum() or after.isalnum() or before == "_" or after == "_" or not checked(kind, body)


def refused_form(kind: int, body: str) -> str | None:
    """A base span as people also write it, which its pattern doesn't match."""
    if kind == 0:
        return body.replace("@", " at ").replace(".", " dot ")
    if kind == 1:
        parts = [int(p.lstrip("0") or "0") for p in body.split(".")]
        joints = ("[.]", " . ", " dot ")
        form = sum(parts) % 4
        if form < 3:
            return joints[form].join(body.split("."))
        return "2001:db8:0:0:0:ffff:%x%02x:%x%02x" % tuple(parts)
    if kind == 3:
        rest = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", body)
        return rest if 7 <= len(_digits(rest)) else None
    return None


@dataclass
class Found:
    """Candidates as columns; ``label`` is NaN where nothing tells."""

    kind: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    role: np.ndarray
    label: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Found:
        kind, start, stop, role, label, x = zip(*rows, strict=True) if rows else ((),) * 6
        labels = np.array([np.nan if v is None else v for v in label], float)
        return cls(*(np.array(c, np.int64) for c in (kind, start, stop, role)), labels, np.array(x, float).reshape(-1, N_FEATURES))

    @classmethod
    def joined(cls, parts: list[Found]) -> Found:
        return cls(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(cls))) if parts else cls.of([])

    def filter(self, mask: np.ndarray) -> Found:
        return Found(*(getattr(self, f.name)[mask] for f in fields(self)))

    def __len__(self) -> int:
        return len(self.kind)


class BaseCover:
    """Tells which spans meet a base span, and which numbers do so without being one."""

    def __init__(self, base: list[tuple[int, int, int]]):
        spans = sorted((a, b) for _, a, b in base)
        self.starts = np.array([a for a, _ in spans], np.int64)
        self.reach = np.maximum.accumulate(np.array([b for _, b in spans], np.int64)) if spans else np.zeros(0, np.int64)
        self.base = base

    def meets(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.starts, stop) - 1
        return (self.reach[np.maximum(at, 0)] > start) & (at >= 0) if len(self.starts) else np.zeros(len(start), bool)

    @cached_property
    def own(self) -> dict[int, np.ndarray]:
        """Starts and stops of base cards and phones: those of a kind don't overlap, the first entry stands before all texts."""
        return {kind: np.array([(-1, -1), *sorted((a, b) for k, a, b in self.base if k == kind)], np.int64).T for kind in FITTING}

    def crossed(self, kind: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Which spans of a card or phone meet a base span and aren't one of their kind."""
        starts, stops = self.own[kind]
        at = np.searchsorted(starts, start, "right") - 1
        return self.meets(start, stop) & ((starts[at] != start) | (stops[at] != stop))


class WindowColumns:
    """``windows``, ``describe`` and ``refuted`` by columns, for texts with very many digit groups."""

    def __init__(self, text: str, groups: list[tuple[int, int]], runs: list[int]):
        self.runs = np.array(runs, np.int64)
        self.starts, self.stops = np.array(groups, np.int64).T
        self.sizes = self.stops - self.starts
        # a blank on either side, so that every place has neighbours; no test takes a blank for anything
        self.points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = len(text)
        is_digit = (self.points >= 48) & (self.points <= 57)
        self.digits_to = np.concatenate([[0], np.cumsum(is_digit)])
        values = np.where(is_digit, self.points.astype(np.int64) - 48, 0)[is_digit]
        doubled = np.where(values > 4, 2 * values - 9, 2 * values)
        even = np.arange(len(values)) % 2 == 0
        self.checks = [np.concatenate([[0], np.cumsum(np.where(even == turn, values, doubled))]) for turn in (True, False)]
        self.signs = {c: np.concatenate([[0], np.cumsum(self.points == ord(c))]) for c in _SEPARATORS}
        bits = np.where(is_digit, 1 << (self.points.astype(np.int64) - 48) % 10, 0)
        pairs = np.stack([self.starts + 1, self.stops + 1], axis=1).ravel()
        self.bits = np.bitwise_or.reduceat(bits, pairs)[::2]
        # no character gets shorter, so texts that stay as long keep all places
        lowered = text.lower()
        if len(lowered) != len(text):
            lowered = "".join(low if len(low := c.lower()) == 1 else c for c in text)
        self.cues = {
            kind: [(len(c), np.array([m.start() for m in re.finditer(f"(?={c})", lowered)], np.int64)) for c in cues]
            for kind, cues in _CUES.items()
        }

    def _told(self, places: np.ndarray, tells: Callable[[str], bool]) -> np.ndarray:
        chars, which = np.unique(self.points[places], return_inverse=True)
        return np.array([tells(chr(c)) for c in chars.tolist()], bool)[which]

    def _cued(self, kind: str, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), bool)
        for size, at in self.cues[kind]:
            if len(at):
                for low, high in ((start - CONTEXT, start), (stop, stop + CONTEXT)):
                    out |= np.searchsorted(at, high - size, "right") > np.searchsorted(at, np.maximum(low, 0), "left")
        return out

    def block(self, first: int, last: int, cover: BaseCover, wrong: bool = False) -> Found:
        """Candidates whose first group is one of ``first`` to ``last - 1``: those that don't meet a base span, or the ``wrong`` ones that do."""
        own = np.arange(first, last)
        if wrong:
            # no stretch has more groups than digits
            farthest = self.stops[np.minimum(own + MOST_DIGITS, len(self.stops)) - 1]
            own = own[cover.meets(self.starts[own] - 1, farthest)]
        high, low, bits = self.sizes[own], self.sizes[own], self.bits[own]
        digits, parts, i = self.sizes[own], [], own
        for width in range(1, MOST_DIGITS + 1):
            j = i + width - 1
            for kind, (least, most) in FITTING.items():
                signed = (kind == 3) & np.isin(self.points[self.starts[i]], (ord("+"), ord("(")))
                span = self.starts[i] - signed, self.stops[j]
                fit = (digits >= least) & (digits <= most) & (cover.crossed(kind, *span) if wrong else ~cover.meets(*span))
                if fit.any():
                    parts.append(self._described(kind, i[fit], j[fit], digits[fit], high[fit], low[fit], bits[fit]))
            on = (digits < MOST_DIGITS) & (j + 1 < len(self.runs))
            on[on] = self.runs[j[on] + 1] == self.runs[i[on]]
            i, j = i[on], j[on] + 1
            if not len(i):
                break
            high, low = np.maximum(high[on], self.sizes[j]), np.minimum(low[on], self.sizes[j])
            digits, bits = digits[on] + self.sizes[j], bits[on] | self.bits[j]
        found = Found.joined(parts)
        return replace(found, role=np.full(len(found), 2), label=np.zeros(len(found))) if wrong else found

    def _described(self, kind, i, j, digits, high, low, bits) -> Found:
        start, stop = self.starts[i], self.stops[j]
        # place p of the text is place p + 1 of the points
        if kind == 3:
            start = start - ((self.points[start] == ord("+")) | (self.points[start] == ord("(")))
        before, after = start, stop + 1
        if kind == 2:
            first, last = self.digits_to[start + 1], self.digits_to[stop + 1]
            sums = np.where(last % 2 == 1, self.checks[0][last] - self.checks[0][first], self.checks[1][last] - self.checks[1][first])
            passed = sums % 10 == 0
        else:
            passed = stop - start != digits
        against = self._told(before, lambda c: c.isalnum() or c == "_") | self._told(after, lambda c: c.isalnum() or c == "_") | ~passed
        distinct = sum((bits >> d) & 1 for d in range(10))
        flags = [
            self._told(before, lambda c: c.isalpha() or c == "_"),
            self._told(after, lambda c: c.isalpha() or c == "_"),
            self._told(before, str.isdigit) | self._told(after, str.isdigit),
            self._told(before, lambda c: c in "=\"'#/"),
            self._told(after, lambda c: c in "\"'/%"),
            self._cued(KINDS[kind], start, stop),
            np.any([self._cued(k, start, stop) for k in KINDS if k != KINDS[kind]], axis=0),
            (i > 0) & (self.runs[i - 1] == self.runs[i]),
            (j + 1 < len(self.runs)) & (self.runs[np.minimum(j + 1, len(self.runs) - 1)] == self.runs[j]),
            *(c[stop + 1] - c[start + 1] for c in self.signs.values()),
            ~against,
        ]
        same = [np.full(len(i), float(kind == k)) for k in range(4)]
        columns = [*same, stop - start, digits, j - i + 1, high, low, self.sizes[i], self.sizes[j], distinct, np.zeros(len(i)), *flags]
        x = np.stack([np.asarray(c, float) for c in columns], axis=1)
        return Found(np.full(len(i), kind), start, stop, np.ones(len(i), np.int64), np.where(against, 0.0, np.nan), x)


def lesson_blocks(text: str, base: list[tuple[int, int, int]]) -> Iterator[Found]:
    """More to learn from: numbers that stand beside other digits, and stretches that cut or cross base spans, which are wrong."""
    out = []
    around = lambda a, b: (text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT])
    for kind, a, b in base:
        if kind >= 2:
            left, body, right = around(a, b)
            out.append((kind, a, b, 2, 1.0, describe(kind, left, body, " 0")))
            out.append((kind, a, b, 2, 1.0, describe(kind, "0 ", body, right)))
        if len(out) >= BLOCK:
            yield Found.of(out)
            out = []
    (groups, runs), cover = digit_groups(text) if base else ([], []), BaseCover(base)
    if 0 < len(groups) <= FEW:
        taken, spans = set(base), windows(text, groups, runs)
        crossing = cover.meets(np.array([a for _, a, _ in spans], np.int64), np.array([b for *_, b in spans], np.int64))
        for span, met in zip(spans, crossing.tolist(), strict=True):
            if met and span not in taken:
                out.append((*span, 2, 0.0, describe(span[0], *around(*span[1:]))))
    if out:
        yield Found.of(out)
    if len(groups) > FEW:
        columns = WindowColumns(text, groups, runs)
        for first in range(0, len(groups), BLOCK):
            yield columns.block(first, min(first + BLOCK, len(groups)), cover, wrong=True)


def lessons(text: str, base: list[tuple[int, int, int]]) -> Found:
    """All of ``lesson_blocks`` at once."""
    return Found.joined(list(lesson_blocks(text, base)))


def candidate_blocks(text: str, base: list[tuple[int, int, int]]) -> Iterator[Found]:
    """Base spans, their refused forms, and proposals that don't meet a base span, with what describes them."""
    cover, out = BaseCover(base), []
    around = lambda a, b: (text[max(0, a - CONTEXT) : a], text[a:b], text[b : b + CONTEXT])
    for kind, a, b in base:
        left, body, right = around(a, b)
        out.append((kind, a, b, 0, 1.0, describe(kind, left, body, right)))
        if form := refused_form(kind, body):
            out.append((kind, a, b, 2, 1.0, describe(kind, left, form, right)))
    more = written_out(text)
    groups, runs = digit_groups(text)
    if len(groups) <= FEW:
        more += windows(text, groups, runs)
    if more:
        apart = ~cover.meets(np.array([a for _, a, _ in more], np.int64), np.array([b for *_, b in more], np.int64))
        for (kind, a, b), free in zip(more, apart.tolist(), strict=True):
            if free:
                parts = around(a, b)
                out.append((kind, a, b, 1, 0.0 if refuted(kind, *parts) else None, describe(kind, *parts)))
    for first in range(0, len(out), BLOCK):
        yield Found.of(out[first : first + BLOCK])
    if len(groups) > FEW:
        columns = WindowColumns(text, groups, runs)
        for first in range(0, len(groups), BLOCK):
            yield columns.block(first, min(first + BLOCK, len(groups)), cover)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Found:
    """All of ``candidate_blocks`` at once."""
    return Found.joined(list(candidate_blocks(text, base)))


class Trees:
    """Boosted trees as arrays, so that tasks score candidates where they are."""

    def __init__(self, nodes: list, weights: list[float]):
        self.weights = weights
        self.trees = []
        for number in range(len(weights)):
            own = sorted((n for n in nodes if n["treeID"] == number), key=lambda n: n["id"])
            self.trees.append(
                tuple(
                    np.array([n[c] for n in own], kind)
                    for c, kind in (("prediction", float), ("left", int), ("right", int), ("feature", int), ("threshold", float))
                )
            )

    @classmethod
    def of(cls, spark: SparkSession, model: GBTClassificationModel, folder: str) -> Trees:
        """From a fitted model, read back from its own files: at most 2 ** (depth + 1) nodes for each tree."""
        model.write().overwrite().save(folder)
        data = spark.read.parquet(f"{folder}/data")
        n = "nodeData"
        rows = data.select(
            "treeID",
            f"{n}.id",
            f"{n}.prediction",
            F.col(f"{n}.leftChild").alias("left"),
            F.col(f"{n}.rightChild").alias("right"),
            F.col(f"{n}.split.featureIndex").alias("feature"),
            F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        ).collect()
        filled = [{**r.asDict(), "threshold": r["threshold"] if r["threshold"] is not None else 0.0} for r in rows]
        return cls(filled, [float(w) for w in model.treeWeights])

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for weight, (value, left, right, feature, threshold) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                inner = left[at] >= 0
                if not inner.any():
                    break
                goes_left = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def fit(found: DataFrame) -> tuple[Trees | None, list[float]]:
    """Trees and the threshold of each kind, from all candidates (one row each) that have a label."""
    part = F.pmod(F.xxhash64("kind", "start", "stop", "role", "x"), F.lit(1 << 20))
    told = found.filter("label IS NOT NULL").select("kind", "x", "label", (part % 5 == 0).alias("kept"))
    rows = staged(told.groupBy("kind", "x", "label", "kept").agg(F.count("*").alias("n")), "pii_alike")
    sizes = {r["label"]: r["rows"] for r in rows.filter("not kept").groupBy("label").agg(F.count("*").alias("rows")).collect()}
    if len(sizes) < 2:
        return None, [2.0] * 4
    # dealt and sorted by what they hold, so that trees don't depend on the order of tasks
    dealt = rows.filter("not kept").repartition(max(2, -(-sum(sizes.values()) // PART_ROWS)), "kind", "x", "label")
    ordered = staged(dealt.sortWithinPartitions("kind", "label", "x"), "pii_training")
    training = ordered.select(array_to_vector("x").alias("features"), "label", F.col("n").cast("double").alias("n")).cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=32, weightCol="n").fit(training)
    training.unpersist()
    spark = found.sparkSession
    trees = Trees.of(spark, model, staging_path(spark, "pii_trees"))
    return trees, thresholds(rows.filter("kept"), trees)


def thresholds(rows: DataFrame, trees: Trees, precision: float = PRECISION) -> list[float]:
    """For each kind the lowest score from which on enough candidates are right; over 1 where there is none.

    ``rows`` has candidates of ``kind`` and ``x``, ``n`` times each. Scores are counted, then summed from the highest one
    on within bins of scores, behind the sums of the bins above.
    """
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.probability(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES))
            n = batch.column(3).to_numpy(zero_copy_only=False)
            right = np.where(batch.column(2).to_numpy(zero_copy_only=False) > 0, n, 0)
            columns = [batch.column(0), pa.array(score), pa.array(n, pa.int64()), pa.array(right, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "score", "n", "right"])

    found = rows.select("kind", "x", "label", "n").mapInArrow(scored, "kind int, score double, n bigint, right bigint")
    counted = staged(found.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("right").alias("right")), "pii_scores")
    binned = counted.withColumn("bin", F.floor(F.col("score") * SCORE_BINS))
    # at most a row for each kind and bin
    above = Window.partitionBy("kind").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    sums = binned.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("right").alias("right"))
    before = sums.select("kind", "bin", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "right")])
    down = Window.partitionBy("kind", "bin").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    running = binned.join(F.broadcast(before), ["kind", "bin"]).select(
        "kind", "score", *[(F.col(f"{c}_above") + F.sum(c).over(down)).alias(c) for c in ("n", "right")]
    )
    good = running.filter(F.col("right") >= F.lit(precision) * F.col("n")).groupBy("kind").agg(F.min("score").alias("least")).collect()
    out = {r["kind"]: r["least"] for r in good}
    return [out.get(kind, 2.0) for kind in range(len(KINDS))]


def calibrated(kinds: np.ndarray, scores: np.ndarray, labels: np.ndarray, precision: float = PRECISION) -> list[float]:
    """The same in numpy, for a few scores."""
    out = []
    for kind in range(len(KINDS)):
        own = kinds == kind
        order = np.argsort(-scores[own], kind="stable")
        value, right = scores[own][order], np.cumsum(labels[own][order])
        last = np.append(value[1:] != value[:-1], True) if len(value) else np.zeros(0, bool)
        good = last & (right >= precision * np.arange(1, len(value) + 1))
        out.append(float(value[good].min()) if good.any() else 2.0)
    return out


def accepted(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of overlapping spans the best score, then the longest, then the first."""
    taken: list[tuple[int, int]] = []
    out = []
    for kind, a, b, _ in sorted(spans, key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        at = bisect.bisect_left(taken, (b, b))
        if at == 0 or taken[at - 1][1] <= a:
            bisect.insort(taken, (a, b))
            out.append((kind, a, b))
    return out


SPANS = [T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))]


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``base`` and ``spans`` (all spans, base ones included), both by kind and start.

    Columns of these names are replaced; ``_found`` is reserved.
    """

    bound_batches(df.sparkSession)
    own = [c for c in df.columns if c != text and c.lower() not in ("base", "spans")]
    source = df.select(*[df[f"`{c}`"] for c in own], df[f"`{text}`"].cast("string").alias("_found"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting: list[Found] = []
            size = 0
            for value in plain(batch.column(0)):
                t = value.as_py()
                base = base_spans(t)
                for block in chain(candidate_blocks(t, base), lesson_blocks(t, base)):
                    waiting.append(block.filter(~np.isnan(block.label)))
                    size += len(waiting[-1])
                    if size >= AT_ONCE:
                        yield _written(Found.joined(waiting))
                        waiting, size = [], 0
            yield _written(Found.joined(waiting))

    trees, limits = fit(source.select("_found").mapInArrow(told, CANDIDATE))
    shared = df.sparkSession.sparkContext.broadcast((trees, limits))
    schema = T.StructType([*(source.schema[c] for c in own), *SPANS])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        trees, limits = shared.value
        arrow, names = to_arrow_schema(schema), SPAN.fieldNames()
        for batch in batches:
            texts = plain(batch.column(len(own)))
            known = [base_spans(t.as_py()) for t in texts]
            fit: list[list[tuple]] = [[] for _ in known]
            waiting: list[tuple[int, Found]] = []

            def flush(waiting=waiting, fit=fit):
                more = Found.joined([f for _, f in waiting])
                row = np.repeat([r for r, _ in waiting], [len(f) for _, f in waiting])
                waiting.clear()
                if len(more):
                    p = trees.probability(more.x)
                    good = np.flatnonzero(p >= np.array(limits)[more.kind])
                    columns = (row, more.kind, more.start, more.stop, p)
                    for r, *span in zip(*(c[good].tolist() for c in columns), strict=True):
                        fit[r].append(tuple(span))

            if trees:
                size = 0
                for r, t in enumerate(texts):
                    for block in candidate_blocks(t.as_py(), known[r]):
                        waiting.append((r, block.filter(block.role == 1)))
                        size += len(waiting[-1][1])
                        if size >= AT_ONCE:
                            flush()
                            size = 0
                flush()
            spans = [sorted([*k, *accepted(f)]) for k, f in zip(known, fit, strict=True)]
            made = [
                pa.array([[dict(zip(names, s, strict=True)) for s in row] for row in rows], arrow.field(n).type)
                for n, rows in (("base", known), ("spans", spans))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *made], names=schema.names)

    return source.mapInArrow(choose, schema)


def _written(found: Found) -> pa.RecordBatch:
    width = pa.array(np.arange(len(found) + 1, dtype=np.int32) * N_FEATURES)
    columns = [
        *(pa.array(c, t) for c, t in ((found.kind, pa.int32()), (found.start, pa.int64()), (found.stop, pa.int64()), (found.role, pa.int32()))),
        pa.array(found.label, pa.float64(), from_pandas=True),
        pa.ListArray.from_arrays(width, pa.array(found.x.ravel(), pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=CANDIDATE.fieldNames())
