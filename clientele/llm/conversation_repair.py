"""Repairing the structure of damaged conversations at least cost, by iterative-deepening A*.

A repair keeps, reroles or deletes each row and inserts rows, so that the
initials of the roles read ``(s?(ua)+)?``. The search goes depth first through
the edits in ASCII order (D, I, K, R) under a bound on the cost; the bound
rises to the least cost that exceeded it (Korf, 1985). A table remembers, per
row and role state, how much a failed state lacked (Reinefeld and Marsland,
1994). The first path accepted is the cheapest, and among those the first in
ASCII order. The estimate of the cost that is left solves runs of ``PATTERN``
rows on their own, whatever the roles around them, and adds them up.

Conversations are cut into blocks of at most ``BLOCK_ROWS`` rows, so no task
holds a long one. Rows are range-partitioned in order and a slice of the order
is cut as it streams by. A block that is a conversation is searched at once. For
the blocks of longer ones a search per entry and exit state gives a table of 16
costs; a pass over these small tables, backwards, gives the cost after each
block; a search per entry state with that cost at its end gives the edits, and
a pass forwards picks them. Texts are hashed while they stream by. An insertion
belongs to the row after it, so the edits of a block never start with those of
another one, and the first in ASCII order is decided block by block.

Defined results: rows with equal turns are ordered by role, then text; a null
role or text is one space, a null in the key of the damage likewise; an empty
role has no initial and must be changed or deleted; a null conv_id is one
conversation; repeated rows are duplicates; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import with_long
from clientele.session import truncate

BLOCK_ROWS = 128
BLOCK_CHARS = 4_000_000
PATTERN = 8
KEY_CHARS = 64  # leading code points of a text that decide in which slice of the order a row lies

# Role states: before all rows, and behind a system, user or assistant row.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
AFTER = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
NEEDED = [USER, USER, ASSISTANT, USER]  # the state that an inserted or reroled row leads to
NAMES = {USER: "user", ASSISTANT: "assistant"}
END = [0, math.inf, math.inf, 0]
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}
_SPACES = " \t\n\x0b\x0c\r"
#: An exit state that is dearer than the cheapest one by more is on no cheapest path: between any two states, four and less make up for it
#: (two rows inserted lead from behind a system row to behind an assistant row, and nothing needs more).
DETOUR = 4

_BLOCKS = ("conv string, slice int, block int, alone boolean, roles array<string>, texts array<string>, faults string, "
           "turns long, first_turn long, last_turn long")
_RESULT = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


# ---- search ----------------------------------------------------------------------------------------------------------

def steps(initial: str, fault: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if fault not in "bd":
        extra = TRUNCATED if fault == "t" else 0
        if initial in AFTER[state]:
            out.append(("K", extra, AFTER[state][initial]))
        out.append(("R", REROLE + extra, NEEDED[state]))
    return out


def estimates(initials: list[str], faults: str, end: list[float]) -> list[list[float]]:
    """A lower bound of the cost that is left, per row and state: runs of rows solved alone, added up."""
    out: list[list[float]] = [list(end)]
    for i in range(len(faults) - 1, -1, -1):
        after = out[-1] if (i + 1) % PATTERN or i + 1 == len(faults) else [min(out[-1])] * 4
        now = [min(cost + after[to] for _, cost, to in steps(initials[i], faults[i], s)) for s in STATES]
        for _ in range(2):
            now = [min(now[s], INSERT + now[NEEDED[s]]) for s in STATES]
        out.append(now)
    return out[::-1]


def search(initials: list[str], faults: str, entry: int, end: list[float], closing: bool,
           limit: float = math.inf) -> tuple[int, str, int] | None:
    """(cost, edits, exit state) of the cheapest path over at least one row, first in ASCII order; None beyond ``limit``.

    ``end``: cost that follows per exit state; it is part of the cost that is
    bounded and returned. ``closing``: rows may be inserted behind the last one.
    """
    n = len(faults)
    table = estimates(initials, faults, [min(end[s], INSERT + end[NEEDED[s]], 2 * INSERT + end[NEEDED[NEEDED[s]]])
                                         for s in STATES] if closing else end)
    bound = table[0][entry]
    while bound <= limit and bound < math.inf:
        # a frame: row, state, cost so far, its edits that are left, least cost that is left, the edit that led here
        stack = [(0, entry, 0, iter(_edits(initials, faults, 0, entry, n, closing)), [math.inf], "")]
        while stack:
            i, state, cost, left, lacking, _ = stack[-1]
            for edit, price, to, used in left:
                j = i + used
                if cost + price + table[j][to] > bound:
                    lacking[0] = min(lacking[0], price + table[j][to])
                    continue
                if j == n and cost + price + end[to] <= bound:
                    return int(cost + price + end[to]), "".join(f[5] for f in stack) + edit, to
                stack.append((j, to, cost + price, iter(_edits(initials, faults, j, to, n, closing)), [math.inf], edit))
                break
            else:
                stack.pop()
                table[i][state] = max(table[i][state], lacking[0])
                if stack:
                    step = cost - stack[-1][2]
                    stack[-1][4][0] = min(stack[-1][4][0], step + table[i][state])
        bound = table[0][entry]
    return None


def _edits(initials: list[str], faults: str, i: int, state: int, n: int, closing: bool) -> list[tuple[str, int, int, int]]:
    insert = [("I", INSERT, NEEDED[state], 0)]
    if i == n:
        return insert if closing else []
    row = [(*step, 1) for step in steps(initials[i], faults[i], state)]
    return row[:1] + insert + row[1:]


def applied(roles: list[str], texts: list[str], state: int, edits: str) -> list[str]:
    """``role:text`` of the rows that the edits leave."""
    out, i = [], 0
    for edit in edits:
        role = roles[i] if edit == "K" else NAMES[NEEDED[state]]
        if edit != "D":
            out.append(f"{role}:{'' if edit == 'I' else texts[i]}")
            state = AFTER[state][role[:1]]
        i += edit != "I"
    return out


# ---- rows and blocks -------------------------------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after dropping, emptying, cutting, repeating and re-roling some rows."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    read = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1).cast("int"))
    return read.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("one")).drop("one")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Each row and whether its role and text were seen earlier in its conversation.

    Equal rows of a turn are counted first; only messages that come in several turns are then looked up.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    counted = counted.withColumn("digest", F.sha2("text", 256)).withColumn("at", F.coalesce("turn", F.lit(-(1 << 63))))
    again = counted.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first_at"), F.count("*").alias("times")).where(
        "times > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first_at")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return (counted.join(again, same, "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("conv_id", "turn", "role", "text", "copy",
                    ((F.col("copy") > 1) | (F.col("at") > F.coalesce("first_at", "at"))).alias("repeat")))


def _cut(frames: Iterator[pd.DataFrame], block_rows: int) -> Iterator[pd.DataFrame]:
    """Blocks of the conversations of a slice, from rows in order."""
    out: list[tuple] = []
    key, rows, chars, block, first, slice_ = None, [], 0, 0, True, 0

    def close(more: bool, last: bool):
        turns = [int(r[0]) for r in rows if r[0] is not None]
        faults = "".join(
            "b" if not (t := text.rstrip(_SPACES)) else "d" if repeat else "t" if t[-1] not in ".!?" else "."
            for _, _, text, repeat in rows)
        out.append((key[0], slice_, block, not (more or last or first or block), [r[1] for r in rows], [r[2] for r in rows], faults,
                    len(set(turns)), turns[0] if turns else None, turns[-1] if turns else None))

    names = [f.split(" ")[0] for f in _BLOCKS.split(", ")]
    for frame in frames:
        for conv, turn, role, text, repeat, part in frame.itertuples(index=False, name=None):
            slice_ = part
            if key is not None and (key[0] != conv or len(rows) >= block_rows or chars >= BLOCK_CHARS):
                changed = key[0] != conv
                close(not changed, False)
                first, block = first and not changed, 0 if changed else block + 1
                rows, chars = [], 0
            key = (conv,)
            rows.append((turn, role, text, repeat))
            chars += len(text)
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)
            out.clear()
    if rows:
        close(False, True)
        yield pd.DataFrame(out, columns=names, dtype=object)


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows in order; ``alone`` ones are whole conversations for certain."""
    order = ["conv_id", "turn", "role", F.left("text", F.lit(KEY_CHARS))]
    placed = _with_repeats(rows).repartitionByRange(*order).sortWithinPartitions(*order, "text", "copy")
    return placed.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text",
                         "repeat", F.spark_partition_id().alias("slice")).mapInPandas(lambda frames: _cut(frames, block_rows), _BLOCKS)


class _Summary:
    """The result of one conversation, block by block in order."""

    def __init__(self):
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.turns = self.cost = 0
        self.first_turn = self.last_turn = None
        self.initial, self.edits, self.hash, self.any = None, [], hashlib.sha256(), False

    def add(self, roles, texts, faults, turns, first_turn, last_turn, entry, edits):
        for kind in self.counts:
            self.counts[kind] += faults.count(kind)
        initials = [r[:1] for r in roles]
        before = [self.initial] if self.initial is not None else []
        self.illegal += sum(a + b not in LEGAL for a, b in zip(before + initials, (before + initials)[1:]))
        self.initial = initials[-1]
        if turns:
            self.turns += int(turns) - (self.last_turn is not None and self.last_turn == first_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn
        self.edits.append(edits)
        rows = applied(roles, texts, entry, edits)
        if rows:
            self.hash.update(("\n" * self.any + "\n".join(rows)).encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self, conv, cost) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (conv, gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, cost, "".join(self.edits),
                self.hash.hexdigest())


def _whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of blocks that are whole conversations."""
    names = [f.split(" ")[0] for f in _RESULT.split(", ")]
    for frame in frames:
        out = []
        for conv, roles, texts, faults, turns, first, last in frame.itertuples(index=False, name=None):
            cost, edits, _ = search([r[:1] for r in roles], faults, START, END, True)
            summary = _Summary()
            summary.add(list(roles), list(texts), faults, int(turns), _int(first), _int(last), START, edits)
            out.append(summary.row(conv, cost))
        yield pd.DataFrame(out, columns=names, dtype=object)


def _int(text) -> int | None:
    return None if text is None or text != text else int(text)


# ---- conversations of several blocks -----------------------------------------------------------------------------------

def _costs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cost of a block from each entry to each exit state; null where that is on no cheapest path."""
    for frame in frames:
        out = []
        for roles, faults in zip(frame["roles"], frame["faults"]):
            initials, costs = [r[:1] for r in roles], []
            for entry in STATES:
                least, _, _ = search(initials, faults, entry, [0] * 4, False)
                for exit_ in STATES:
                    end = [0 if s == exit_ else math.inf for s in STATES]
                    found = search(initials, faults, entry, end, False, least + DETOUR)
                    costs.append(found[0] if found else None)
            out.append(costs)
        yield frame[["conv", "slice", "block"]].assign(costs=out)


def _cost_after(frame: pd.DataFrame) -> pd.DataFrame:
    """Cost after each block of one conversation, per exit state, from the last block to the first."""
    frame = frame.sort_values(["slice", "block"])
    after, out = [0, 2 * INSERT, INSERT, 0], []
    for k, costs in enumerate(reversed(frame["costs"].tolist())):
        out.append([*after, k == 0])
        after = [min(math.inf if c is None or c != c else c + after[x] for x, c in zip(STATES, costs[4 * s:4 * s + 4]))
                 for s in STATES]
    return pd.DataFrame({
        "conv": frame["conv"], "slice": frame["slice"], "block": frame["block"],
        "after": [[None if x == math.inf else int(x) for x in o[:4]] for o in reversed(out)], "is_last": [o[4] for o in reversed(out)]})


def _paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per entry state of a block: the edits that continue best, the exit state and the cost up to the end."""
    for frame in frames:
        out = []
        for roles, faults, after, is_last in zip(frame["roles"], frame["faults"], frame["after"], frame["is_last"]):
            end = END if is_last else [math.inf if x is None or x != x else int(x) for x in after]
            found = [search([r[:1] for r in roles], faults, s, end, bool(is_last)) for s in STATES]
            out.append(([f[1] if f else None for f in found], [f[2] if f else None for f in found], [f[0] if f else None for f in found]))
        yield frame[["conv", "slice", "block"]].assign(
            edits=[o[0] for o in out], exits=[o[1] for o in out], totals=[o[2] for o in out])


def _chosen(frame: pd.DataFrame) -> pd.DataFrame:
    """The path through the blocks of one conversation: entry, edits and the cost of all."""
    state, total, rows = START, None, []
    for conv, slice_, block, edits, exits, totals in frame.sort_values(["slice", "block"]).itertuples(index=False, name=None):
        total = int(totals[state]) if total is None else total
        rows.append((conv, slice_, block, state, edits[state], total))
        state = int(exits[state])
    return pd.DataFrame(rows, columns=["conv", "slice", "block", "entry", "edits", "cost"])


def _streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of conversations whose blocks come in order."""
    names = [f.split(" ")[0] for f in _RESULT.split(", ")]
    key = summary = cost = None
    for frame in frames:
        out = []
        for conv, roles, texts, faults, turns, first, last, entry, edits, total in frame.itertuples(index=False, name=None):
            if summary is None or key != conv:
                if summary is not None:
                    out.append(summary.row(key, cost))
                key, summary, cost = conv, _Summary(), int(total)
            summary.add(list(roles), list(texts), faults, int(turns), _int(first), _int(last), int(entry), edits)
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)
    if summary is not None:
        yield pd.DataFrame([summary.row(key, cost)], columns=names, dtype=object)


def _long(cut: DataFrame) -> DataFrame:
    """Results of the conversations whose blocks may be several."""
    place = "conv string, slice int, block int"
    rows = ["conv", "slice", "block", "roles", "faults"]
    costs = cut.select(*rows).mapInPandas(_costs, place + ", costs array<long>")
    after = costs.groupBy("conv").applyInPandas(_cost_after, place + ", after array<long>, is_last boolean")
    paths = _same_block(cut.select(*rows), truncate(after)).mapInPandas(
        _paths, place + ", edits array<string>, exits array<int>, totals array<long>")
    chosen = paths.groupBy("conv").applyInPandas(_chosen, place + ", entry int, edits string, cost long")
    ordered = _same_block(cut.drop("alone"), truncate(chosen)).repartition("conv").sortWithinPartitions("conv", "slice", "block")
    return ordered.select("conv", "roles", "texts", "faults", "turns", F.col("first_turn").cast("string"),
                          F.col("last_turn").cast("string"), "entry", "edits", "cost").mapInPandas(_streamed, _RESULT)


def _same_block(cut: DataFrame, other: DataFrame) -> DataFrame:
    """Blocks with what was found for them; a slice and block belong to one conversation, null or not."""
    named = other.select(F.col("conv").alias("c"), F.col("slice").alias("s"), F.col("block").alias("b"),
                         *[x for x in other.columns if x not in ("conv", "slice", "block")])
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")) & (F.col("block") == F.col("b"))
    return cut.join(named, same).drop("c", "s", "b")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation of ``rows``."""
    cut = truncate(blocks(rows.select("conv_id", "turn", "role", "text"), block_rows))
    short = cut.where("alone").select("conv", "roles", "texts", "faults", "turns", F.col("first_turn").cast("string"),
                                      F.col("last_turn").cast("string")).mapInPandas(_whole, _RESULT)
    found = short.unionByName(_long(cut.where("not alone")))
    return with_long(found.withColumnRenamed("conv", "conv_id"), "conv_id")


def repair_damaged(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``repair`` of the damaged rows, one row per conversation of the table, those without any row left included."""
    found = repair(damage(conversations), block_rows).withColumnRenamed("conv_id", "_found")
    everyone = conversations.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return everyone.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
