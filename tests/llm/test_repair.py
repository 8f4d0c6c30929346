"""Branch and bound against trying everything, and whole conversations against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from coursetide.llm import repair

from ..conftest import TESTDATA
from .data import CLASHES

NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def apply(codes, audit):
    """Roles and cost of an audit, None if it does not fit the turns."""
    roles, cost, k = [], 0, 0
    for edit in audit:
        if edit == "I":
            roles.append(NEXT[roles[-1] if roles else ""])
            cost += 5
            continue
        if k == len(codes):
            return None
        code, k = codes[k], k + 1
        if edit == "D":
            cost += 2
            continue
        if code == "x":
            return None
        cost += 5 * code.isupper() + (edit == "R")
        roles.append(code.lower() if edit == "K" else NEXT[roles[-1] if roles else ""])
        if roles[-1] == "o" or (roles[-1] == "s" and len(roles) > 1):
            return None
    if k < len(codes) or not re.fullmatch("(s?(ua)+)?", "".join(roles)):
        return None
    return cost


def tried(codes, inserts=2):
    """The best audit of all there are with so many inserts at the most."""
    found = []
    for size in range(len(codes), len(codes) + inserts + 1):
        for audit in itertools.product("DIKR", repeat=size):
            if audit.count("I") == size - len(codes):
                cost = apply(codes, "".join(audit))
                if cost is not None:
                    found.append((cost, "".join(audit)))
    return min(found)


def by_states(codes, entry=0, exits=(0, 3)):
    """The best audit by a table of states, each turn after the other."""

    def with_inserts(table):
        for _ in range(4):
            for s, (cost, audit) in list(table.items()):
                t = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                table[t] = min(table.get(t, (cost + 5, audit + "I")), (cost + 5, audit + "I"))
        return table

    table = with_inserts({entry: (0, "")})
    for code in codes:
        ways = []
        for s, (cost, audit) in table.items():
            ways.append((s, cost + 2, audit + "D"))
            if code == "x":
                continue
            extra = 5 * code.isupper()
            ways.append(({0: 2, 1: 2, 2: 3, 3: 2}[s], cost + 1 + extra, audit + "R"))
            t = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, code.lower()))
            if t is not None:
                ways.append((t, cost + extra, audit + "K"))
        table = {}
        for t, cost, audit in ways:
            table[t] = min(table.get(t, (cost, audit)), (cost, audit))
        with_inserts(table)
    return min((table[e] for e in exits if e in table), default=None)


def plain(rows, block=None):
    """``rows`` of (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, n in rows if c == conv for _ in range(n)]

        def order(row):
            digest = hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest()
            return row[0] is not None, row[0] or 0, digest

        turns.sort(key=order)
        numbers = {t for t, _, _ in turns if t is not None}
        found = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        codes, seen = [], set()
        for _, role, text in turns:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not bare:
                found["blank"] += 1
                code = "x"
            elif (role, text) in seen:
                found["duplicate"] += 1
                code = "x"
            elif bare[-1] not in ".!?":
                found["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes.append(code)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit = by_states(codes)
        texts, k = [], 0
        last = ""
        for edit in audit:
            if edit == "I":
                last = NEXT[last]
                texts.append(({"u": "user", "a": "assistant"}[last], ""))
                continue
            _, role, text = turns[k]
            k += 1
            if edit == "K":
                last = role[:1]
                texts.append((role, text))
            elif edit == "R":
                last = NEXT[last]
                texts.append(({"u": "user", "a": "assistant"}[last], text))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in texts).encode()).hexdigest()
        out[conv] = (gaps, *found.values(), illegal, cost, audit, sha)
    return out


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield conv, turn, "user" if fault == 4 else role, text, {0: 0, 3: 2}.get(fault, 1)


def table(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    return df.select("*", *(F.lit("own").alias(c) for c in (*CLASHES, "digest", "block", "info"))) if clash else df


def report(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[name] for name in NAMES) for r in rows}


def test_search_equals_trying_everything():
    for size in range(5):
        for codes in itertools.product("suAx" if size > 3 else "suaoUAx", repeat=size):
            assert repair.search("".join(codes))[:2] == tried(codes), codes


@pytest.mark.parametrize("exits", [(0, 3), (0,), (1,), (2,), (3,)])
def test_search_from_and_to_every_state(exits):
    draw = random.Random(7)
    for size in range(14):
        for _ in range(60):
            codes = "".join(draw.choice("suaoUASxuaua") for _ in range(size))
            for entry in range(4):
                found = repair.search(codes, entry, exits)
                assert (found and found[:2]) == by_states(codes, entry, exits), (codes, entry)


def test_bounds_are_never_too_high():
    draw = random.Random(8)
    for _ in range(300):
        codes = "".join(draw.choice("suaoUAxua") for _ in range(8))
        low = repair.bounds(codes, (0, 3))
        for k in range(9):
            assert low[k] <= min(by_states(codes[k:], entry)[0] for entry in range(4))


def test_long_ones_end_soon():
    draw = random.Random(9)
    codes = "".join(draw.choices("uaUAxo", (40, 40, 2, 2, 4, 1), k=600))
    assert repair.search(codes)[:2] == by_states(codes)


def test_query_equals_plain(spark):
    folder = str(TESTDATA / "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = report(registry.queries()["op11_branch_and_bound"](spark, folder))
    assert found == plain(list(damage(rows)))
    assert sum(f[5] for f in found.values()) > 0


AWKWARD = [
    (1, 0, "system", "Be kind.", 1),
    (1, 1, "user", "Why?", 1),
    (1, 2, "assistant", "Because", 1),
    (1, 2, "assistant", "Because.", 1),
    (1, 9, "user", "Why?", 3),
    (2, None, "user", "No turn.", 1),
    (2, None, "assistant", "None here.", 1),
    (2, 4, None, None, 1),
    (3, 1, "user", "gone.", 0),
    (None, 1, "user", "No conversation.", 1),
    (None, 2, "assistant", "Still.", 2),
    (4, 1, "", "No role.", 1),
    (4, 2, "User", "Capital.", 1),
    (4, 3, "user", " \t\n", 1),
    (4, 3, "a", "漢字!  \r\n", 1),
    (5, 1, "user", "long " * 50_000 + ".", 1),
    (5, 2, "assistant", "x?", 1),
    (6, None, "user", "dropped", 0),
    (6, None, "user", "Kept.", 1),
]


@pytest.mark.parametrize("block", [1, 2, 256])
def test_awkward_rows(spark, block):
    assert report(repair.audits(table(spark, AWKWARD, clash=True), counted=True, block=block)) == plain(AWKWARD)


def many():
    """One conversation with most of the turns, in which one text comes again and again."""
    draw = random.Random(3)
    rows = [(7, t, draw.choice(("user", "assistant")), draw.choice(("Same.", f"Own {t}.", f"Own {t}")), draw.choice((1, 1, 1, 0, 2))) for t in range(700)]
    return rows + [(c, t, "ua"[t % 2] * 3, f"{c} {t}.", 1) for c in range(8, 40) for t in range(4)]


@pytest.mark.parametrize("block", [5, 64])
def test_a_conversation_over_many_tasks(spark, block):
    rows = many()
    assert report(repair.audits(table(spark, rows).repartition(5), counted=True, block=block)) == plain(rows)


def test_repaired_turns_are_those_of_the_digest(spark):
    rows = many() + AWKWARD
    turns = repair.repaired(table(spark, rows), counted=True).collect()
    want = plain(rows)
    for conv in want:
        own = sorted((r.place, r.role, r.text) for r in turns if r.conv_id == conv)
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in own))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in own).encode()).hexdigest() == want[conv][-1]


def test_rows_without_counts(spark):
    rows = [(1, 0, "user", "Hi.", 1), (1, 0, "user", "Hi.", 1), (1, 1, "assistant", "Yes.", 1)]
    assert report(repair.audits(table(spark, rows).drop("copies"))) == plain(rows)


def test_no_rows(spark):
    assert repair.audits(table(spark, [])).count() == 0
    assert repair.repaired(table(spark, [])).count() == 0
