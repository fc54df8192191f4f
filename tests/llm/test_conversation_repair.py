"""Searches and whole repairs against dynamic programming over all edits."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest

from clientele.llm import conversation_repair as cr
from clientele.llm import queries

SF = "/root/testdata/sf0.01"
SPACES = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(roles, faults, state="", end=lambda s: 0 if s in ("", "a") else math.inf, closing=True):
    """(cost, edits) from the last row to the first, each state with its cheapest and then ASCII-least edits."""
    states, fresh = ("", "s", "u", "a"), {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {s: (end(s), "") for s in states}
    for i in range(len(roles), -1, -1):
        if i < len(roles):
            now = {}
            for s in states:
                options = [(3 + best[s][0], "D" + best[s][1])]
                if faults[i] not in "bd":
                    extra = faults[i] == "t"
                    if to := NEXT.get((s, roles[i][:1])):
                        options.append((extra + best[to][0], "K" + best[to][1]))
                    for to in {t for (f, _), t in NEXT.items() if f == s and t != "s"}:
                        options.append((2 + extra + best[to][0], "R" + best[to][1]))
                now[s] = min(options)
            best = now
        if i < len(roles) or closing:
            for _ in range(4):
                best = {s: min(best[s], (2 + best[fresh[s]][0], "I" + best[fresh[s]][1])) for s in states}
    return best[state]


def brute_force(rows):
    groups, out = {}, {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({46: None, 33: None, 63: None}) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), ""
        for _, role, text in found:
            t = text.rstrip(SPACES)
            faults += "b" if not t else "d" if (role, text) in seen else "t" if t[-1] not in ".!?" else "."
            seen.add((role, text))
        turns = {t for t, _, _ in found if t is not None}
        roles = [r for _, r, _ in found]
        cost, edits = cheapest(roles, faults) if found else (0, "")
        lines, i, state = [], 0, ""
        for e in edits:
            to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            role = roles[i] if e == "K" else {"u": "user", "a": "assistant"}[to]
            if e != "D":
                lines.append(f"{role}:{'' if e == 'I' else found[i][2]}")
                state = role[:1]
            i += e != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum((a[:1] + b[:1]) not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, edits,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_search_finds_the_first_cheapest_edits(seed):
    rng = random.Random(seed)
    number = {"": cr.START, "s": cr.SYSTEM, "u": cr.USER, "a": cr.ASSISTANT}
    for _ in range(150):
        n = rng.randint(1, 22)
        roles = rng.choices(["user", "assistant", "system", "tool", ""], [6, 6, 2, 1, 0.3], k=n)
        faults = "".join(rng.choices("..tbd", k=n))
        assert cr.search([r[:1] for r in roles], faults, cr.START, cr.END, True)[:2] == cheapest(roles, faults)
        ends = [rng.choice([0, 1, 2, 5, math.inf]) for _ in range(3)] + [3]
        entry = rng.choice(list(number))
        want = cheapest(roles, faults, entry, lambda s: ends[number[s]], False)
        assert cr.search([r[:1] for r in roles], faults, number[entry], ends, False)[:2] == want


@pytest.mark.parametrize("block_rows", [cr.BLOCK_ROWS, 2])
def test_query_equals_brute_force(spark, block_rows):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = (queries.QUERIES["op12_conversation_repair"](spark, SF) if block_rows == cr.BLOCK_ROWS
           else cr.repair_damaged(table, block_rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(got) == brute_force(rows)


@pytest.mark.parametrize("block_rows", [cr.BLOCK_ROWS, 7])
def test_odd_and_long_conversations(spark, block_rows):
    rng = random.Random(11)
    says = ["Yes.", "No", "", " \n", "Well!", None, "ünïcode?", "three\nlines\n."]
    name = lambda: rng.choice(["user", "assistant", "system", None, "", "tool", "user", "assistant"])
    rows = [(c, rng.choice([None, *range(9)]), name(), rng.choice(says) if rng.random() < 0.5 else f"{rng.random()}.")
            for c in [*range(12), None] for _ in range(rng.randint(0, 14))]
    rows += [(500, t, ["user", "assistant"][rng.random() < 0.5], f"turn {t // 2}" + ".?x"[rng.randint(0, 2)]) for t in range(1500)]
    rows += [(501, 3, "user", "again.")] * 400 + [(502, 1 << 60, "user", "x" * 300_000 + "."), (502, 5, "assistant", "")]
    rows += [(503 + i, 0, "system", "only.") for i in range(25)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "q", 2) for r in rows],
                                  "conv_id long, turn long, role string, text string, slice int, conv string, block int")
    assert rows_of(cr.repair_damaged(table, block_rows)) == brute_force(rows)


def test_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_damaged(table).count() == 0
