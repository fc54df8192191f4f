"""Tokens against the library, placement against the rule spelt out, and whole packings."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm import packing, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_path())


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(packing.default_path())


ODD = " \t\n\x0b\x1c\x1f\x85\xa0\u2003\u200b 'sdTé1²;<|\U0001f600\u0301ß"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ODD, max_size=20), max_size=4))
def test_tokens_equal_the_library(tokens, library, parts):
    text = "<|endoftext|>".join(parts)
    assert np.frombuffer(tokens.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_tokens_around_code_points_equal_the_library(tokens, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 31 == 0)]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)};" for c in points]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(tokens.encode(text), "<u4").tolist() == want.ids


def by_the_rule(lengths, limit):
    """Sum of squares computed anew for every open bin with room, the smallest gap first; a new bin only without one."""
    gaps = []
    for s in lengths:
        best = None
        for b in sorted((b for b, g in enumerate(gaps) if g >= s), key=lambda b: gaps[b]) or [len(gaps)]:
            after = [*gaps[:b], (gaps[b] if b < len(gaps) else limit) - s, *gaps[b + 1:]]
            total = sum(n * n for g, n in Counter(after).items() if g)
            if best is None or total < best[0]:
                best = total, after
        gaps = best[1]
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_placement_follows_the_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(70)]
    bins, offsets, gaps = packing.place(np.array(lengths), 20)
    assert sorted(gaps.tolist()) == by_the_rule(lengths, 20)
    for b in set(bins.tolist()):
        inside = sorted((o, lengths[i]) for i, (x, o) in enumerate(zip(bins, offsets)) if x == b)
        assert [o for o, _ in inside] == np.cumsum([0] + [n for _, n in inside])[:-1].tolist()
        assert sum(n for _, n in inside) == 20 - gaps[b]


def check(rows, texts, library, limit=packing.SEQUENCE):
    """Rows of all documents together: pieces are whole documents in order, sequences are gapless and short enough."""
    found = {}
    for r in rows:
        found.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in found.values():
        inside.sort()
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:i]) for i in range(len(inside))]
        assert sum(n for _, n in inside) <= limit
    want = []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) if len(ids) <= limit else len(ids) % limit
        starts = ([0] if first else []) + list(range(first, len(ids), limit))
        for k, (a, b) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    return len(found), sum(r.length for r in rows) / limit


def test_query_packs_all_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.QUERIES["op13_best_fit_packing"](spark, SF).collect()
    used, least = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library)
    assert used <= least * 1.005 + 1


def test_small_units_pack_over_several_levels(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(packing.pieces(docs), unit_rows=40, left_rows=25).collect()
    assert len({r.sequence_id >> 56 for r in rows}) >= 3
    used, least = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library)
    assert used <= least * 1.04 + 1


def test_odd_documents(spark, library):
    texts = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (None, None), (5, "word " * 5000), (5, "word " * 5000), (6, "x" * 100_000),
             (7, "end <|endoftext|> of"), (8, "a " * 1023), (9, "a " * 1024), (1 << 60, "large id")]
    docs = spark.createDataFrame([(*t, 1, 2, "z") for t in texts], "doc_id long, text string, length int, unit int, sequence_id string")
    rows = packing.pack_documents(docs).collect()
    assert rows[0].__fields__ == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(rows, texts, library)
    with_ids = packing.pack_documents(docs, ids_out=True).where("doc_id = 7").first()
    assert with_ids.ids == library.encode("end <|endoftext|> of", add_special_tokens=False).ids + [2]
    empty = packing.pack_documents(docs.limit(0))
    assert empty.count() == 0 and empty.columns == list(rows[0].__fields__)


def test_lengths_that_never_fit_stay_bounded(spark):
    rows = packing.pack(spark.range(0, 1000, 1, 4).selectExpr("id", "600L as length"), unit_rows=50, left_rows=20).collect()
    assert len({r.sequence_id for r in rows}) == 1000 and {r.offset for r in rows} == {0}
