"""Near words against brute force, the machine against its definition, odd texts."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from clientele.llm import queries, spelling

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows):
    """All variants by trying every deletion, replacement and insertion that meets in a shared pattern."""
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    replaced, near = {}, {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            replaced.setdefault((w[:i], w[i + 1:]), []).append(w)
            if (v := w[:i] + w[i + 1:]) in n:
                near[w].add(v)
                near[v].add(w)
    for group in replaced.values():
        for w in group:
            near[w].update(group)
    form = {}
    for w, others in near.items():
        others.discard(w)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, folder):
    path = SF.replace("sf0.001", folder)
    want = brute_force(duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall())
    got = queries.QUERIES["op11_spelling_variants"](spark, path)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = rows_of(got)
    assert got == want and any(v[0] for v in want.values())


def test_dense_words_and_chains(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(40))) for i in range(60)]
    rows += [(100, "aaaaaaaaa " * 300), (101, "aaaaaaaaaa " * 3000), (102, "aaaaaaaab " * 30000)]
    rows += [(110 + i, w) for i, w in enumerate(["x" * 30_000, "x" * 30_000, "x" * 29_999 + "y", "x" * 29_999 + "y"])]
    got = rows_of(spelling.document_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute_force(rows)
    assert got == want
    assert any(v[0] and v[0] != v[1] for v in want.values())  # a form that has a form itself


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, "short words"), (None, "without id, ÀÉÎõü÷× without"), (None, None), (4, "straÿenXX straÿenxx stràÿenxx stràÿenxx"),
            (4, "straÿenXX straÿenxx stràÿenxx stràÿenxx"), (5, "a" * 20_000 + " " + "a" * 20_000)]
    docs = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "doc_id long, text string, n int, word string, n_near int")
    assert rows_of(spelling.document_variants(docs)) == brute_force(rows)
    empty = spelling.document_variants(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_machine_is_minimal_and_complete():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(6)) for _ in range(200)})
    machine = spelling.Machine()
    start = machine.initial(words)
    accepted, todo = [], [("", start)]
    while todo:
        word, state = todo.pop()
        if not state:
            accepted.append(word)
        todo += [(word + c, t) for c, t in machine.arcs[state].items()]
    assert sorted(accepted) == words
    endings = {frozenset(w[i:] for w in words if w[:i] == p) for i in range(7) for p in {w[:i] for w in words}}
    assert len(machine.arcs) == len(endings)  # one state per set of endings: none can be saved
    pairs = {(u, v) for u, v in machine.near(start, None, True)}
    assert {frozenset(p) for p in pairs} == {frozenset((u, v)) for u in words for v in words if sum(a != b for a, b in zip(u, v)) == 1}
