"""Grouping spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary is an acceptor A, minimised while it is built from sorted words
(Daciuk, Mihov, Watson and Watson, 2000). Let T be the transducer that copies
a word but for one edit. The pairs that A o T o A accepts are the near words.

The composition is partitioned by initial state. A near pair shares the first
or the last half of its shorter word, so each word starts in the state reached
after its first half, and, for edits inside that half, in the state of its
last half. A key is the length of the shorter word, the side and the half: it
grows with the words, so even a common half is shared by few, and tasks hold
the words of one key at a time. Pairs whose edit is in the first half are
taken on the other side only; an inserted code point differs from the one that
follows it: so each pair is accepted along one path and counted once.

A task returns a count and the best near word per word and key, never pairs,
and Spark adds them up.

Defined results: a null or empty text has no words; a null id counts as the
empty text in the hash of the damage; repeated rows count as often as they
occur; ties go to the smaller word in code-point order; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.session import truncate

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
LETTERS = "A-Za-zÀ-ÿ"
DAMAGE_EVERY = 31
#: A task forgets its machine beyond this many states.
STATES = 300_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COPY, _EDITED, _ALIGNED, _INSERTED = range(4)


def runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, run): maximal runs of letters of at least ``min_length`` code points, A-Z in lower case."""
    lowered = F.translate(text, _UPPER, _LOWER)
    found = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def damaged(doc_id: Column, run: Column, every: int = DAMAGE_EVERY) -> Column:
    """The run without one code point, where the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(words: DataFrame, word: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length(word) >= min_length).groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


class Machine:
    """Minimised acceptors of words of equal length, with shared states; state 0 accepts the empty word."""

    def __init__(self):
        self.register: dict[tuple, int] = {(): 0}
        self.arcs: list[dict[str, int]] = [{}]

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        found = self.register.get(key)
        if found is None:
            found = self.register[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
        return found

    def initial(self, words: list[str]) -> int:
        """The initial state of the minimal acceptor of sorted, distinct words of one length."""
        length = len(words[0])
        open_: list[list[tuple[str, int]]] = [[] for _ in range(length + 1)]
        last = words[0]
        for word in [*words[1:], ""]:
            same = 0
            if word:
                while last[same] == word[same]:
                    same += 1
            target = 0
            for depth in range(length - 1, same - 1, -1):
                open_[depth].append((last[depth], target))
                if depth > same:
                    target = self._state(open_[depth])
                    open_[depth] = []
            last = word
        return self._state(open_[0])

    def near(self, short: int, long: int | None, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs that the composition accepts: one code point replaced within ``short``, or put into it to give one of ``long``.

        ``at_end``: whether a code point may be put behind the last one.
        """
        arcs = self.arcs
        todo: list[tuple] = [(0, "", "", short, _COPY, "", short)]
        if long is not None:
            todo.append((0, "", "", short, _ALIGNED, "", long))
        left: list[str] = []
        right: list[str] = []
        while todo:
            depth, a, b, p, edit, put, q = todo.pop()
            del left[depth:], right[depth:]
            left.append(a)
            right.append(b)
            depth += 1
            here, there = arcs[p], arcs[q]
            if edit == _EDITED:
                if not p and not q:
                    yield "".join(left), "".join(right)
                elif p == q:
                    todo += [(depth, c, c, t, _EDITED, "", t) for c, t in here.items()]
                else:
                    todo += [(depth, c, c, here[c], _EDITED, "", there[c]) for c in here.keys() & there.keys()]
            elif edit == _COPY:
                branches = list(here.items())
                for i, (c, t) in enumerate(branches):
                    todo.append((depth, c, c, t, _COPY, "", t))
                    todo += [(depth, c, d, t, _EDITED, "", u) for d, u in branches[i + 1:]
                             if t == u or not arcs[t].keys().isdisjoint(arcs[u])]
            elif edit == _ALIGNED:
                todo += [(depth, c, c, here[c], _ALIGNED, "", there[c]) for c in here.keys() & there.keys()]
                todo += [(depth, "", c, p, _INSERTED, c, t) for c, t in there.items()
                         if (at_end if not p else not here.keys().isdisjoint(arcs[t]))]
            elif not p:
                yield "".join(left), "".join(right)
            else:
                todo += [(depth, c, c, here[c], _EDITED, "", there[c]) for c in here.keys() & there.keys() if c != put]


def _starts(vocab: DataFrame, min_length: int) -> DataFrame:
    """Each word at its initial states: (size, first, half, longer, rest, n).

    ``size`` is the length of the shorter word of a pair, ``first`` the side of
    the shared half; a word is the shorter one or, with one code point more,
    the longer one.
    """
    length = F.length("word")
    sizes = F.array(*[F.struct((length - k).cast("int").alias("size"), F.lit(bool(k)).alias("longer")) for k in (0, 1)])
    words = vocab.select("word", "n", F.explode(sizes).alias("s")).select("word", "n", "s.*").where(F.col("size") >= min_length)
    half = F.floor(F.col("size") / 2).cast("int")
    rest = F.length("word") - (F.col("size") - half)
    sides = F.array(
        F.struct(F.lit(True).alias("first"), F.substr("word", F.lit(1), half).alias("half"), F.substr("word", half + 1).alias("rest")),
        F.struct(F.lit(False).alias("first"), F.substr("word", rest + 1).alias("half"), F.substr("word", F.lit(1), rest).alias("rest")))
    return words.select("size", "longer", "n", F.explode(sides).alias("p")).select(
        "size", "p.first", "p.half", "longer", "p.rest", "n")


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    machine, key, groups = Machine(), None, ({}, {})
    out: list[tuple] = []

    def finish():
        nonlocal machine
        short, long = groups
        if len(short) + len(long) < 2 or not short:
            return
        if len(machine.arcs) > STATES:
            machine = Machine()
        _, first, half = key
        best: dict[tuple[bool, str], list] = {}
        long_state = machine.initial(list(long)) if long else None
        for a, b in machine.near(machine.initial(list(short)), long_state, at_end=first):
            x, y = (False, a), (len(b) > len(a), b)
            for word, other in ((x, y), (y, x)):
                rank = (-groups[other[0]][other[1]], other[1])
                state = best.get(word)
                if state is None:
                    best[word] = [1, rank]
                else:
                    state[0] += 1
                    state[1] = min(state[1], rank)
        for (_, rest), (near, (n, other)) in best.items():
            word, form = (half + rest, half + other) if first else (rest + half, other + half)
            out.append((word, near, form, -n))

    for frame in frames:
        for *place, longer, rest, n in frame.itertuples(index=False, name=None):
            if place != key:
                finish()
                key, groups = place, ({}, {})
            groups[longer][rest] = n
        yield pd.DataFrame(out, columns=["word", "n_near", "form", "form_n"])
        out.clear()
    finish()
    yield pd.DataFrame(out, columns=["word", "n_near", "form", "form_n"])


def near_words(vocab: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have near words: how many, and the most frequent of them."""
    key = ["size", "first", "half"]
    found = (_starts(vocab, min_length).repartition(*key).sortWithinPartitions(*key, "longer", "rest")
             .mapInPandas(_compare, "word string, n_near long, form string, form_n long"))
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.form").alias("form"), (-F.col("b.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form, by doubling the steps.

    A form is ``FORM_RATIO`` times as frequent as its word, so there are no
    circles and a chain has no more links than a count has digits.
    """
    state = truncate(links.select("word", F.col("form").alias("root")))
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = truncate(state.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        state = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return state


def variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, form_ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each distinct word of ``words(word)``."""
    vocab = truncate(vocabulary(words, min_length=min_length, min_count=min_count))
    found = near_words(vocab, min_length)
    strong = F.col("form_n") >= F.col("n") * form_ratio
    near = truncate(vocab.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")))
    last = roots(near.where("form is not null"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """``variants`` of the words of documents, some of them damaged so that there are misspellings to find."""
    found = runs(docs, text)
    return variants(found.select(damaged(F.col("doc_id"), F.col("run")).alias("word")))
