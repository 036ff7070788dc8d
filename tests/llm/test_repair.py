import hashlib
import random
import re
import sys
from functools import lru_cache
from zlib import crc32

import pytest

from headwater.llm import repair as R
from headwater.llm.survivors import Survivors
from headwater.llm.tables import table

sys.setrecursionlimit(20_000)
BLANKS = " \t\n\v\f\r"


def cheapest(initials, faults):
    """(cost, audit) by trying every edit from the last row back, insertions at any place."""

    def follow(state, c):
        return (c == "s" and state == "") or (c == "u" and state in ("", "s", "a")) or (c == "a" and state == "u")

    @lru_cache(None)
    def best(i, state, inserted):
        out = []
        if i == len(initials) and state in ("", "a"):
            out.append((0, ""))
        if inserted < 2:
            out += [(5 + c, "I" + e) for t in "ua" if follow(state, t) for c, e in [best(i, t, inserted + 1)]]
        if i < len(initials):
            out += [(2 + c, "D" + e) for c, e in [best(i + 1, state, 0)]]
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if initials[i] in ("s", "u", "a") and follow(state, initials[i]):
                    out += [(more + c, "K" + e) for c, e in [best(i + 1, initials[i], 0)]]
                out += [(1 + more + c, "R" + e) for t in "ua" if follow(state, t) for c, e in [best(i + 1, t, 0)]]
        return min(out) if out else (10**9, "")

    return best(0, "", 0)


def brute(rows):
    """The report of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(BLANKS)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = cheapest(tuple(initials), tuple(faults))
    state, left, at = "", [], 0
    for letter in audit:
        if letter == "I":
            state = "a" if state == "u" else "u"
            left.append((R.ROLES[state], ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "K":
            state = role[0]
            left.append((role, text))
        elif letter == "R":
            state = "a" if state == "u" else "u"
            left.append((R.ROLES[state], text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in left))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return ((max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0), *counts, illegal, cost, audit, digest), left


def conversations(rng, n, longest):
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \t", "a\x85", None, "Yes.", "end.\n", "long " * 30 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    rows = []
    for c in range(n):
        conv = None if c == 3 else c
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.05 else t + (rng.random() < 0.1)
            row = (conv, turn, rng.choice(roles[:5] if rng.random() < 0.8 else roles), rng.choice(texts[:4] if rng.random() < 0.7 else texts))
            rows += [row] * (1 if rng.random() < 0.9 else 3)
    return rows


def grouped(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


@pytest.mark.parametrize(("longest", "block"), [(6, 256), (12, 1), (12, 3), (60, 7)])
def test_reports_are_those_of_trying_all_edits(spark, monkeypatch, longest, block):
    rows = conversations(random.Random(longest + block), 120, longest)
    monkeypatch.setattr(R, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, cost long").repartition(5)
    want = {c: brute(r) for c, r in grouped(rows).items()}
    got = {r.conv_id: tuple(r)[1:9] for r in R.report(df).collect()}
    assert got == {c: w for c, (w, _) in want.items()}
    turns = {}
    for r in sorted(R.repaired_turns(df).collect(), key=lambda r: tuple(r.place)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: left for c, (_, left) in want.items() if left}


def test_a_conversation_over_many_ranges(spark, monkeypatch):
    """Most rows belong to one conversation; its ranges are entered in states that earlier ranges decide."""
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "cut", " ", f"Row {t}.", f"Row {t}.", f"Row {t}!"])) for t in range(600)]
    rows += conversations(rng, 20, 5)[:40]
    monkeypatch.setattr(R, "BLOCK_ROWS", 16)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    blocks = R._in_order(df).select("conv_id", "part").distinct().where("conv_id = 1").count()
    assert blocks > 1
    got = {r.conv_id: tuple(r)[1:9] for r in R.report(df).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {c: brute(r)[0] for c, r in grouped(rows).items()}


def test_the_query_damages_and_repairs_the_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    left = {}
    for c, t, role, text in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        own = left.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            own += [row, row] if kind == 3 else [row]
    got = R.op13_conversation_repair(spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == {c: brute(r)[0] for c, r in left.items()}
    assert len({c for c, *_ in rows}) == got.count()


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.report(none).count() == 0
    assert R.repaired_turns(none).count() == 0


def test_memory_stays_bounded_while_survivors_agree():
    """100,000 rows of one conversation: edits come out all along, and only the unresolved end is held."""
    rng = random.Random(4)
    trellis, out, most = Survivors(R.START, R.APART), 0, 0
    for _ in range(100_000):
        out += len(trellis.step(R.moves(rng.choice("ua"), rng.choice([0, 0, 0, 3]), 0)))
        most = max(most, max(len(p) for _, p in trellis.paths().values()))
    assert out > 99_000
    assert most < 300
    cost, rest, _ = trellis.finish(R.ENDINGS)
    assert out + len(rest) == 100_000
    assert cost > 0
