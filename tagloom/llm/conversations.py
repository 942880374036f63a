"""Repair the structure of conversations: align their turns to the grammar ``(system? (user assistant)+)?``.

A target of a given length is one fixed string of role initials (``ua`` repeated, with an ``s`` ahead if the length is
odd), so a conversation is aligned to each feasible length by Wagner-Fischer. Lengths share their ends, so the cells of
one matrix, filled from its end, serve all of them. Only the cells are filled that a path within the incumbent cost can
pass (Ukkonen's band): the incumbent is the cost of a greedy walk, and the band is widened as long as it proves too
narrow. Lengths that tie are traced back and their audits compared.

A conversation of any size is cut into blocks of ``BLOCK`` turns, which are aligned apart: for each role a block may be
entered after and each it may be left with, its cheapest edits. What blocks are chosen is then settled from their costs
and the order of their audits, a few numbers per block. Conversations of one block, which is nearly all, need none of
that. The result is the same for any size of blocks.

Faults of a turn, the first of which counts: *blank* (no character beyond ``[\\x20\\x09-\\x0D]``), *duplicate* (its role
and text stood earlier in the conversation), *truncated* (its last character that is not blank isn't one of ``.!?``).
Edits: ``K``\\ eep, ``R``\\ erole, ``D``\\ elete (the only one for blank and duplicate turns), ``I``\\ nsert an empty turn.
Of the cheapest edits the audit that is least in ASCII order wins.

A null role or text counts as one space, a null conversation is a conversation. Turns are ordered by number (null first),
then by role and text, so rows that repeat a number have a fixed order and repeated rows are duplicates. Roles other than
those beginning with s, u or a can only be reroled or deleted. An empty table gives empty results; other columns are not
looked at. Texts are never read by the alignment, and a long one costs what moving it does.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.batches import bound_batches
from tagloom.operators.ranking import largest_group, rank_rows
from tagloom.operators.sizing import MAX_GROUP_ROWS, staged

BLOCK = 256
FAULTS = ("blank", "duplicate", "truncated")
#: A turn as one letter: its initial (u, a, s, other) and its fault (none, blank, duplicate, truncated).
CODES = "ABCDEFGHIJKLMNOP"
INITIALS = "uas?"
NAMES = {"u": "user", "a": "assistant"}
START, END = "^", "$"
INFINITE = math.inf


@dataclass(frozen=True)
class Costs:
    """Whole numbers above zero; keeping a turn is free. ``truncated`` is added for each such turn that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.rerole, self.delete, self.insert) < 1 or self.truncated < 0:
            raise ValueError("edits must cost at least 1, and a truncated turn at least 0")


def as_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def _fault(text: Column) -> Column:
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]++\z", "")
    return F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(3)


def turns(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Written table of all turns: ``conv``, ``turn``, ``role``, ``text``, ``at`` (counted from 1), ``n`` and ``code``."""
    rows = df.select(
        F.col(f"`{key}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        as_text(F.col(f"`{role}`")).alias("role"),
        as_text(F.col(f"`{text}`")).alias("text"),
    )
    largest = largest_group(rows, ["conv"])
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = rank_rows(rows, ["conv"], order, "at", largest=largest, max_group_rows=max_group_rows)
    if largest <= max_group_rows:
        same = Window.partitionBy("conv", "role", "text").orderBy("at")
        placed = placed.withColumns({
            "repeated": F.row_number().over(same) > 1,
            "n": F.count(F.lit(1)).over(Window.partitionBy("conv")),
        })
    else:
        # counts combined before their shuffle take the place of windows over a conversation that fits no task
        placed = staged(placed.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), "turns")
        firsts = placed.groupBy(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest")).agg(F.min("at").alias("first"))
        sizes = placed.groupBy(F.col("conv").alias("s_conv")).agg(F.count("*").alias("n"))
        placed = placed.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest")))
        placed = placed.join(sizes, F.col("conv").eqNullSafe(F.col("s_conv"))).withColumn("repeated", F.col("at") > F.col("first"))
    fault = _fault(F.col("text"))
    fault = F.when(fault == 1, 1).when(F.col("repeated"), 2).otherwise(fault)
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    code = F.substring(F.lit(CODES), initial * 4 + fault + 1, F.lit(1))
    return staged(placed.select("conv", "turn", "role", "text", "at", "n", code.alias("code")), "turns")


class Alignment:
    """All ways to align a block of turns; cell ``(i, r)`` is the least cost of turns ``i`` onwards and ``r`` more targets."""

    def __init__(self, codes: str, costs: Costs, last: bool):
        self.costs, self.last = costs, last
        kinds = [divmod(CODES.index(c), 4) for c in codes]
        self.rows = [(INITIALS[k], f in (1, 2), costs.truncated if f == 3 else 0) for k, f in kinds]
        self.matrices: dict[str, list[dict[int, float]]] = {}
        self.width = self._greedy()

    def _greedy(self) -> int:
        """Cost of one walk: delete what must go, give every other turn the role that comes next, drop an odd one."""
        cost, expected = self.costs.delete, "u"
        for initial, gone, extra in self.rows:
            if gone:
                cost += self.costs.delete
            else:
                cost += extra + (initial != expected) * self.costs.rerole
                expected = "a" if expected == "u" else "u"
        return cost

    def _fill(self, final: str) -> None:
        """Cells of targets that end in ``final``, within the band of ``self.width``."""
        c, n = self.costs, len(self.rows)
        below: dict[int, float] = {0: 0}
        if self.last:
            below.update({r: r * c.insert for r in range(1, self.width // c.insert + 1)})
        matrix = [below]
        for i in range(n - 1, -1, -1):
            initial, gone, extra = self.rows[i]
            left, row = n - i, {}
            for r in range(max(0, left - self.width // c.delete), left + self.width // c.insert + 1):
                best = below.get(r, INFINITE) + c.delete
                if r:
                    best = min(best, row.get(r - 1, INFINITE) + c.insert)
                    if not gone:
                        wrong = initial != self._next(final, r)
                        best = min(best, below.get(r - 1, INFINITE) + extra + wrong * c.rerole)
                row[r] = best
            matrix.append(row)
            below = row
        self.matrices[final] = matrix[::-1]

    @staticmethod
    def _next(final: str, r: int) -> str:
        """Role of the first of the last ``r`` targets."""
        return final if r % 2 else ("a" if final == "u" else "u")

    def _trace(self, final: str, i: int, r: int) -> str:
        """The least audit from a cell on: at each cell the least letter that keeps the cost."""
        matrix, c, audit = self.matrices[final], self.costs, []
        while i < len(self.rows) or r:
            cost = matrix[i][r]
            if i < len(self.rows) and matrix[i + 1].get(r, INFINITE) + c.delete == cost:
                audit.append("D")
                i += 1
            elif r and matrix[i].get(r - 1, INFINITE) + c.insert == cost:
                audit.append("I")
                r -= 1
            else:
                audit.append("R" if self.rows[i][0] != self._next(final, r) else "K")
                i, r = i + 1, r - 1
        return "".join(audit)

    def _starts(self, entry: str, final: str) -> Iterator[tuple[float, int, int, str]]:
        """Cells from which a block entered after ``entry`` may go on, with the cost and the edits before them."""
        expected = "a" if entry == "u" else "u"
        top = self.matrices[final][0]
        for r, cost in top.items():
            if r == 0:
                # nothing is left of the block, so it is left as it was entered; an empty conversation is a whole one
                if entry == final or (self.last and entry == START):
                    yield cost, 0, 0, ""
            elif self._next(final, r) == expected:
                yield cost, 0, r, ""
        if entry == START:
            for i, (initial, gone, extra) in enumerate(self.rows):
                before = i * self.costs.delete + extra
                if before - extra > self.width:
                    break
                if initial == "s" and not gone:
                    for r, cost in self.matrices[final][i + 1].items():
                        if r and self._next(final, r) == "u":
                            yield before + cost, i + 1, r, "D" * i + "K"

    def best(self, entry: str, exit_: str) -> tuple[int, str]:
        """Least cost, and least audit of that cost, from ``entry`` to ``exit_``: START, s, u, a, or END."""
        if exit_ in (START, "s"):
            return self._without_pairs(entry, exit_)
        final = "a" if exit_ == END else exit_
        while True:
            if final not in self.matrices:
                self._fill(final)
            starts = list(self._starts(entry, final))
            least = min((s[0] for s in starts), default=INFINITE)
            if least <= self.width:
                return least, min(head + self._trace(final, i, r) for cost, i, r, head in starts if cost == least)
            self.width *= 2
            self.matrices.clear()

    def _without_pairs(self, entry: str, exit_: str) -> tuple[float, str]:
        """Blocks of which nothing stays, or a system turn alone."""
        n, c = len(self.rows), self.costs
        if entry == exit_:
            return n * c.delete, "D" * n
        if (entry, exit_) != (START, "s"):
            return INFINITE, ""
        ways = [((n - 1) * c.delete + extra, "D" * i + "K" + "D" * (n - 1 - i)) for i, (k, gone, extra) in enumerate(self.rows) if k == "s" and not gone]
        return min(ways, default=(INFINITE, ""))


def block_options(codes: str, first: bool, last: bool, costs: Costs) -> list[tuple[str, str, int, str]]:
    """``(entry, exit, cost, audit)`` of a block for each role it may be entered after and left with."""
    alignment = Alignment(codes, costs, last)
    ways = []
    for entry in START if first else (START, "s", "u", "a"):
        for exit_ in END if last else (START, "s", "u", "a"):
            cost, audit = alignment.best(entry, exit_)
            if cost < INFINITE:
                ways.append((entry, exit_, cost, audit))
    return ways


def choose(blocks: list[dict[tuple[str, str], tuple[int, str]]]) -> list[tuple[str, str]]:
    """Entry and exit of each block of a conversation; what stands at an ``(entry, exit)`` is its cost and a number in
    the order of the block's audits."""
    ahead = [{END: 0}]
    for block in reversed(blocks):
        least: dict[str, float] = {}
        for (entry, exit_), (cost, _) in block.items():
            least[entry] = min(least.get(entry, INFINITE), cost + ahead[-1].get(exit_, INFINITE))
        ahead.append(least)
    ahead.reverse()
    path, entry = [], START
    for i, block in enumerate(blocks):
        ways = [(place, x) for (e, x), (cost, place) in block.items() if e == entry and cost + ahead[i + 1].get(x, INFINITE) == ahead[i][entry]]
        exit_ = min(ways)[1]
        path.append((entry, exit_))
        entry = exit_
    return path


OPTIONS = "block bigint, single boolean, illegal bigint, entry string, exit string, cost bigint, place int, audit string"


def _options(blocks: DataFrame, costs: Costs) -> DataFrame:
    """Each block's ways, with the number of illegal pairs of neighbours that end in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        legal = {("s", "u"), ("u", "a"), ("a", "u")}
        for batch in batches:
            columns = batch.to_pydict()
            rows, out = [], []
            for k, (codes, before, block, blocks_) in enumerate(
                zip(columns["codes"], columns["before"], columns["block"], columns["blocks"], strict=True)
            ):
                initials = [INITIALS[CODES.index(c) // 4] for c in (before or "") + codes]
                illegal = sum(pair not in legal for pair in zip(initials, initials[1:]))
                ways = block_options(codes, block == 0, block == blocks_ - 1, costs)
                order = {audit: i for i, audit in enumerate(sorted({w[3] for w in ways}))}
                for entry, exit_, cost, audit in ways:
                    rows.append(k)
                    out.append((block, blocks_ == 1, illegal, entry, exit_, cost, order[audit], audit))
            fields = [f.split() for f in OPTIONS.split(", ")]
            types = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32()}
            made = [pa.array([o[i] for o in out], types[kind]) for i, (_, kind) in enumerate(fields)]
            conv = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([conv, *made], names=["conv", *(name for name, _ in fields)])

    columns = blocks.select("conv", "codes", "before", "block", "blocks")
    return columns.mapInArrow(run, f"conv {blocks.schema['conv'].dataType.simpleString()}, {OPTIONS}")


def edits(turns_: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """``conv``, ``block``, ``illegal``, ``entry``, ``exit``, ``cost``, ``audit`` of every block of every conversation.

    ``turns_`` comes from ``turns``. The audits of a conversation's blocks, one after the other, are its audit.
    """
    spark = turns_.sparkSession
    bound_batches(spark)
    number = F.floor((F.col("at") - 1) / F.lit(block))
    grouped = turns_.groupBy("conv", number.alias("block"), F.ceil(F.col("n") / F.lit(block)).alias("blocks")).agg(
        F.sort_array(F.collect_list(F.struct("at", "code"))).alias("coded")  # at most ``block`` turns
    )
    coded = grouped.withColumn("codes", F.array_join(F.col("coded.code"), ""))
    before = F.lag(F.substring("codes", -1, 1)).over(Window.partitionBy("conv").orderBy("block"))
    options = staged(_options(coded.withColumn("before", before), costs), "alignments")
    alone = options.filter("single")

    def settle(ways: pd.DataFrame) -> pd.DataFrame:
        table: dict[int, dict] = {}
        for number, entry, exit_, cost, place in zip(ways["block"], ways["entry"], ways["exit"], ways["cost"], ways["place"], strict=True):
            table.setdefault(number, {})[entry, exit_] = (cost, place)
        path = choose([table[k] for k in sorted(table)])
        return pd.DataFrame({
            "w_conv": [ways["conv"].iloc[0]] * len(path),
            "w_block": sorted(table),
            "w_entry": [e for e, _ in path],
            "w_exit": [x for _, x in path],
        })

    kind = turns_.schema["conv"].dataType.simpleString()
    several = options.filter("NOT single")
    ways = several.select("conv", "block", "entry", "exit", "cost", "place")
    chosen = ways.groupBy("conv").applyInPandas(settle, f"w_conv {kind}, w_block bigint, w_entry string, w_exit string")
    met = (
        F.col("conv").eqNullSafe(F.col("w_conv"))
        & (F.col("block") == F.col("w_block"))
        & (F.col("entry") == F.col("w_entry"))
        & (F.col("exit") == F.col("w_exit"))
    )
    picked = several.join(chosen, met, "left_semi")
    return alone.unionByName(picked).select("conv", "block", "illegal", "entry", "exit", "cost", "audit")


PLAN = "at bigint, sub int, edit string, initial string"


def block_plan(first_at: int, entry: str, exit_: str, audit: str) -> Iterator[tuple[int, int, str, str | None]]:
    """``(at, sub, edit, initial)`` of each edit of a block."""
    staying = len(audit) - audit.count("D")
    # from the start, a system turn stays just where the number of turns that stay doesn't fit the last of them
    system = entry == START and staying > 0 and (exit_ == "s" or staying % 2 == (exit_ != "u"))
    at, sub, expected = first_at, 0, "s" if system else "a" if entry == "u" else "u"
    for letter in audit:
        yield at, sub, letter, None if letter == "D" else expected
        if letter != "D":
            expected = "a" if expected == "u" else "u"
        at, sub = (at, sub + 1) if letter == "I" else (at + 1, 0)


def plan(edits_: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per edit: ``conv``, ``at`` of the turn it is about (an insert's is the turn it comes before), ``sub``, its
    place among the edits there, ``edit``, and the ``initial`` of the turn that results (null where it is deleted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            rows, out = [], []
            for k, way in enumerate(zip(columns["block"], columns["entry"], columns["exit"], columns["audit"], strict=True)):
                for edit in block_plan(way[0] * block + 1, *way[1:]):
                    rows.append(k)
                    out.append(edit)
            made = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string()))]
            conv = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([conv, *made], names=["conv", "at", "sub", "edit", "initial"])

    kind = edits_.schema["conv"].dataType.simpleString()
    return edits_.select("conv", "block", "entry", "exit", "audit").mapInArrow(run, f"conv {kind}, {PLAN}")


def repaired(turns_: DataFrame, plan_: DataFrame) -> DataFrame:
    """The turns that result: ``conv``, ``at``, ``sub`` (their order), ``edit``, ``role`` and ``text``."""
    staying = plan_.filter("edit <> 'D'").select(F.col("conv").alias("p_conv"), F.col("at").alias("p_at"), "sub", "edit", "initial")
    met = F.col("conv").eqNullSafe(F.col("p_conv")) & (F.col("at") == F.col("p_at")) & (F.col("edit") != "I")
    given = F.when(F.col("initial") == "u", NAMES["u"]).otherwise(NAMES["a"])
    joined = staying.join(turns_.select("conv", "at", "role", "text"), met, "left")
    return joined.select(
        F.col("p_conv").alias("conv"),
        F.col("p_at").alias("at"),
        "sub",
        "edit",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(given).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def report(turns_: DataFrame, edits_: DataFrame) -> DataFrame:
    """Per conversation: ``gaps`` in its numbers, ``blank``, ``duplicate``, ``truncated`` turns, ``illegal`` pairs of
    neighbours, ``cost`` and ``audit`` of its repair."""
    kinds = [F.count(F.when(F.instr(F.lit(CODES), F.col("code")) % 4 == (i + 2) % 4, 1)).alias(f) for i, f in enumerate(FAULTS)]
    span = F.max("turn").cast("bigint") - F.min("turn").cast("bigint") + 1 - F.count_distinct("turn")
    counted = turns_.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), *kinds)
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], "")
    costs = edits_.groupBy(F.col("conv").alias("e_conv")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    return counted.join(costs, F.col("conv").eqNullSafe(F.col("e_conv"))).drop("e_conv")


def digests(repaired_: DataFrame) -> DataFrame:
    """``conv`` and the SHA-256 of its repaired turns as lines ``role:text``.

    A digest of a whole conversation can only be worked out from its first line to its last, in one task; the lines are
    sorted by Spark and pass through it a batch at a time, so none is ever held whole.
    """
    bound_batches(repaired_.sparkSession)
    lines = repaired_.repartition("conv").sortWithinPartitions("conv", "at", "sub")
    kind = repaired_.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, current = None, None
        for batch in batches:
            done_conv, done = [], []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest is None or conv != current:
                    if digest is not None:
                        done_conv.append(current)
                        done.append(digest.hexdigest())
                    digest, current = hashlib.sha256(), conv
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_conv, batch.column(0).type), pa.array(done, pa.string())], names=["conv", "digest"])
            last_type = batch.column(0).type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], last_type), pa.array([digest.hexdigest()])], names=["conv", "digest"])

    return lines.select("conv", "role", "text").mapInArrow(run, f"conv {kind}, digest string")


def repair(df: DataFrame, costs: Costs = Costs(), block: int = BLOCK, **columns: str) -> DataFrame:
    """The repaired turns of ``df``; see ``turns`` for the names of its columns and ``repaired`` for those of the result."""
    numbered = turns(df, **columns)
    return repaired(numbered, plan(edits(numbered, costs, block), block))
