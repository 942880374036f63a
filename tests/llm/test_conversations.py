import hashlib
import random
import re
from collections import defaultdict
from functools import cache

import pytest

from tagloom.llm import conversations
from tagloom.llm.conversations import Costs

SCHEMA = "conv_id bigint, turn int, role string, text string"
NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub("[\x20\x09-\x0d]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds, c):
    """Cheapest and then least audit, by recursion over turns and the role that came last; two inserts in a row change nothing."""

    @cache
    def go(i, state, inserts):
        ways = [(0, "")] if i == len(rows) and state in "^a" else []
        follow = NEXT[state]

        def add(cost, letter, rest):
            ways.append((cost + rest[0], letter + rest[1]))

        if inserts < 2:
            add(c.insert, "I", go(i, follow, inserts + 1))
        if i < len(rows):
            add(c.delete, "D", go(i + 1, state, 0))
            if kinds[i] not in ("blank", "duplicate"):
                extra = c.truncated if kinds[i] == "truncated" else 0
                initial = rows[i][1][:1]
                if initial == follow:
                    add(extra, "K", go(i + 1, follow, 0))
                else:
                    add(extra + c.rerole, "R", go(i + 1, follow, 0))
                if state == "^" and initial == "s":
                    add(extra, "K", go(i + 1, "s", 0))
        return min(ways, default=(10**9, ""))

    return go(0, "^", 0)


def repaired(rows, audit):
    staying = len(audit) - audit.count("D")
    out, expected, i = [], "s" if staying % 2 else "u", 0
    for letter in audit:
        name = {"u": "user", "a": "assistant", "s": "system"}[expected]
        if letter == "I":
            out.append(f"{name}:")
        else:
            if letter != "D":
                out.append(f"{rows[i][1] if letter == 'K' else name}:{rows[i][2]}")
            i += 1
        if letter != "D":
            expected = NEXT[expected]
    return out


def brute(rows, costs):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        kinds = faults(own)
        numbers = [r[0] for r in own if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(tuple(own), kinds, costs)
        digest = hashlib.sha256("\n".join(repaired(own, audit)).encode()).hexdigest()
        out[conv] = (gaps, *(kinds.count(f) for f in conversations.FAULTS), illegal, cost, audit, digest)
    return out


def found(spark, rows, costs=Costs(), block=conversations.BLOCK, **options):
    turns = conversations.turns(spark.createDataFrame(rows, SCHEMA), **options)
    edits = conversations.edits(turns, costs, block)
    lines = conversations.repaired(turns, conversations.plan(edits, block))
    digests = {r["conv"]: r["digest"] for r in conversations.digests(lines).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {
        r["conv"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], digests.get(r["conv"], empty))
        for r in conversations.report(turns, edits).collect()
    }


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = ["yes.", "no!", "why?\n", "because ", "", " \t", None, "ok."]
    roles = ["user", "assistant", "assistant", "user", "system", "tool", "", None, "User"]
    out = []
    for conv in range(120):
        turn = 0
        for _ in range(rng.randint(1, 14)):
            turn += rng.choice([0, 1, 1, 1, 3])
            text = rng.choice(texts)
            out.append((conv, rng.choice([turn] * 9 + [None]), rng.choice(roles[: rng.choice([2, 9])]), text and text.strip(" ") + str(rng.randint(0, 4)) + text))
    out += [(None, 1, "user", "a."), (None, 2, "assistant", "b.")]
    out += [(900, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(90) if t % 7]
    return out


@pytest.mark.parametrize("costs", [Costs(), Costs(rerole=3, delete=4, insert=1, truncated=2), Costs(1, 1, 1, 0)])
@pytest.mark.parametrize("block", [conversations.BLOCK, 3, 1])
def test_against_recursion(spark, rows, costs, block):
    """The same repairs, inserts among them, for any costs and any size of blocks."""
    assert found(spark, rows, costs, block) == brute(rows, costs)


def test_conversations_too_large_for_a_window(spark, rows):
    assert found(spark, rows, block=4, max_group_rows=5) == brute(rows, Costs())


def test_narrow_bands_are_widened():
    codes = "AEAEEAEAIAEAEEEEEEAAAAEAE"
    whole = conversations.Alignment(codes, Costs(), True)
    narrow = conversations.Alignment(codes, Costs(), True)
    whole.width, narrow.width = 1000, 1
    assert whole.best("^", "$") == narrow.best("^", "$")


def test_unknown_roles_and_single_turns(spark):
    rows = [(1, 0, "system", "a."), (2, 0, "tool", "a."), (3, 0, "user", "a"), (4, 0, "system", "s."), (4, 1, "user", "a."), (4, 2, "assistant", "b")]
    got = found(spark, rows)
    assert [got[k][6] for k in (1, 2, 3, 4)] == ["D", "D", "D", "RRD"] and got[4][5] == 4


def test_empty_table_and_long_text(spark):
    assert found(spark, []) == {}
    got = found(spark, [(1, 0, "user", "x " * 2_000_000 + "?"), (1, 1, "assistant", "y" * 3_000_000)])
    assert got[1][:7] == (0, 0, 0, 1, 0, 4, "DD")


def test_other_columns_and_names(spark):
    rows = spark.createDataFrame([("a", 1, "user", "x.", 5, 6), ("a", 2, "assistant", "y.", 5, 6)], "c string, t int, r string, x string, at int, n int")
    got = conversations.repair(rows, key="c", turn="t", role="r", text="x").orderBy("at").collect()
    assert [(r["conv"], r["edit"], r["role"], r["text"]) for r in got] == [("a", "K", "user", "x."), ("a", "K", "assistant", "y.")]


def test_costs_are_checked():
    with pytest.raises(ValueError):
        Costs(insert=0)
