"""The operators against brute force, round trips and held-out accuracy, with odd inputs."""

import hashlib
import json
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clientele.llm import (bpe, html_text, license_scan, mixing, multi_index, pii, queries, simhash, suffix_dedup, toxicity,
                           tree_forest)

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def texts():
    return [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall()]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, repeated, very long texts, null ids and columns whose names the operators use themselves."""
    rows = [(1, None, "a"), (2, "", None), (3, " \t\n", "b"), (4, "same words here " * 20, "a"), (5, "same words here " * 20, "a"),
            (5, "same words here " * 20, "a"), (None, "no id at all", "c"), (7, "x" * 200_000, "c"), (8, "word " * 60_000, "b"),
            (9, "mail me: jo.doe@example.org or +1 (234) 567-8901", "b")]
    return (spark.createDataFrame(rows, "doc_id long, text string, source string")
            .withColumns({c: F.lit(1) for c in ("packed", "key", "fp", "component", "leaf", "_id", "_score", "tag", "copies", "n_chars", "a", "b")}))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars int")


# ---- suffix dedup --------------------------------------------------------------------------------------------------

def removed_bytes(rows):
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: r[0]):
        data, gone = (text or "").encode(), set()
        for s in range(len(data) - 99):
            first = seen.setdefault(data[s:s + 100], (doc, s))
            if first < (doc, s):
                gone.update(range(s, s + 100))
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        out[doc] = (len(data), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("bucket_rows", [suffix_dedup.BUCKET_ROWS, 30])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, bucket_rows):
    rng = random.Random(4)
    words = ["".join(rng.choice("etaonié") for _ in range(rng.randint(1, 8))) for _ in range(50)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, rows = [line(rng.randint(10, 50)) for _ in range(6)], []
    for i in range(120):
        kind = rng.random()
        text = line(rng.randint(0, 60)) + (rng.choice(shared) + " " + line(15) if kind < 0.5 else "")
        if kind < 0.1:
            text = rng.choice(shared) * 3
        elif 0.6 < kind < 0.7 and rows:
            text = rng.choice(rows)[1]
        elif 0.7 < kind < 0.76:
            text = "ab" * rng.randint(40, 300)
        rows.append((i, text))
    rows += [(200, None), (201, ""), rows[3], rows[3]]
    plain = suffix_dedup.repeats
    monkeypatch.setattr(suffix_dedup, "repeats", lambda docs: plain(docs, bucket_rows, 300))
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = removed_bytes(rows)
    assert len(got) == len(rows) and all(tuple(r)[1:] == want[r.doc_id] for r in got)


def test_suffix_dedup_tells_many_texts_of_one_id_apart(spark):
    rng = random.Random(12)
    shared = "".join(rng.choice("abcdefgh") for _ in range(130))
    texts = []
    for _ in range(3000):
        own = "".join(rng.choice("ijklmnop") for _ in range(260))
        at = rng.randint(0, 260)
        texts.append(own[:at] + shared + own[at:] if rng.random() < 0.5 else own)
    first = {}
    for t in texts:
        for s in range(len(t) - 99):
            first[t[s:s + 100]] = min(s, first.get(t[s:s + 100], s))
    want = []
    for t in texts:
        gone = {i for s in range(len(t) - 99) if s > first[t[s:s + 100]] for i in range(s, s + 100)}
        want.append((len(t), len(gone), hashlib.sha256("".join(c for i, c in enumerate(t) if i not in gone).encode()).hexdigest()))
    got = suffix_dedup.dedup(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert sorted((r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_places_in_texts_of_many_pieces(monkeypatch):
    """Each window of a text belongs to one anchor at its true place, however many pieces the text and its batch have."""
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "_POSITION", np.uint64((1 << 10) - 1))
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes() for n in (5000, 120, 99, 2500, 400)]
    texts[0] = texts[0][:4000] + texts[3][700:1000] + texts[0][4300:]
    docs = np.arange(len(texts))
    found = suffix_dedup._batch_anchors(docs, np.zeros(len(texts), np.int64), texts)
    for i, text in enumerate(texts):
        own = found[(found.doc == i) & (found.packed >= 0)]
        cuts = suffix_dedup.cut(text, own.packed.to_numpy())
        assert sorted(s for at, lo, hi, *_ in cuts for s in range(at - hi, at - lo + 1)) == list(range(len(text) - 99))
        for at, lo, hi, *_ in cuts:  # equal windows have equal anchors
            grams = [suffix_dedup._gram_hashes(text[s:s + 32], 1)[0] & ~np.uint64(1023) for s in range(at - lo, at - lo + 69)]
            assert grams.index(min(grams)) == lo


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (500, 24), dtype=np.uint8)
    order = suffix_dedup.multikey_quicksort(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_suffix_dedup_odd_inputs(spark, odd, empty):
    got = suffix_dedup.dedup(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[1].n_bytes == 0 and by[4].n_removed == 304 and by[5].n_removed == 320
    assert by[7].n_removed == 200_000 - 1 and suffix_dedup.dedup(empty).count() == 0


# ---- vectors -------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 32))
    x[100:160] = x[99] + 0.02 * rng.normal(size=(60, 32))
    x[300:330] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 32), (1002, [float("nan")] + [1.0] * 31), (1003, [None] + [1.0] * 31), rows[7]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit("other")), x


def test_tree_forest_finds_the_links(vectors):
    df, x = vectors
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in tree_forest.near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    assert got[159].component_id == 99 and got[310].component_id == 5 and not got[310].kept and got[5].kept
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(1000, 1004))


def test_tree_forest_keeps_its_recall_in_deep_trees():
    """Pairs at the bound, in trees as deep as 3 million spread vectors make them."""
    x = np.random.default_rng(8).normal(size=(16384, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.random.default_rng(9).normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * y / np.linalg.norm(y, axis=1, keepdims=True)
    width, apart = tree_forest.margin(64), np.ones(len(x), bool)
    for tree in tree_forest.grow(x, 3_000_000):
        of_y = {leaf: rows for rows, leaf in tree.leaves(y, width)}
        for rows, leaf in tree.leaves(x, width):
            apart[np.intersect1d(rows, of_y.get(leaf, rows[:0]))] = False
    assert apart.mean() < 0.001


def test_multi_index_recall_and_order(vectors):
    df, x = vectors
    got = multi_index.nearest(df).collect()
    hits = 0
    for q in range(0, len(x), 20):
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:20]
        assert len(rows) == 20 and all(abs(r.score - score[r.vec_id]) < 1e-9 for r in rows)
        assert [r.vec_id for r in rows] == [r.vec_id for r in sorted(rows, key=lambda r: (-r.score, r.vec_id))]
        hits += len({int(b) for b in best} & {r.vec_id for r in rows})
    assert hits / (20 * len(range(0, len(x), 20))) >= 0.9
    assert not {r.query_id for r in got} & {1000, 1001, 1002, 1003}


def test_multi_index_returns_every_code_in_the_radius():
    rng = np.random.default_rng(3)
    packed = rng.integers(0, 256, (400, 32), dtype=np.uint8)
    packed[1:60] = packed[0] ^ (rng.random((59, 32)) < 0.3) * rng.integers(0, 8, (59, 32)).astype(np.uint8)
    block = multi_index.Block(packed)
    for radius in (0, 5, 31, 32, 70):
        want = np.flatnonzero(np.bitwise_count(packed ^ packed[0]).sum(1) <= radius)
        assert block.within(packed[0], radius).tolist() == want.tolist()


def test_vectors_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert tree_forest.near_duplicates(none).count() == 0 and multi_index.nearest(none).count() == 0


# ---- texts ---------------------------------------------------------------------------------------------------------

def test_license_scan(texts):
    idx = license_scan.index(tuple(license_scan.TEMPLATES.items()))
    long = license_scan.TEMPLATES["MIT-text"].replace("a copy", "one copy").replace("associated ", "")
    found = license_scan.scan(f"é {long} end. Released under the MIT License.", idx)
    assert [f[0] for f in found] == ["MIT-text", "MIT"] and found[0][3] < 1 and found[1][3] == 1
    notice = re.compile("licensed under|MIT License", re.I)
    for t in texts:
        assert bool(notice.search(t)) == bool(license_scan.scan(t, idx))
        for _, a, b, c in license_scan.scan(t, idx):
            assert "icens" in t[a:b] and c >= license_scan.COVERAGE


@pytest.mark.parametrize("text, names", [
    ("Released under the BSD License", ["BSD"]), ("Licensed under CC BY 4.0", ["CC-BY-4.0-short"]),
    ("Licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]), ("Licensed under CC BY-ND 4.0", []),
    ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0"]),
    ("This is licensed under the GNU General Public License, version 3", ["GPL-3.0"]), ("released under the mit license", ["MIT"]),
    ("a Licensed under the Apache License, Version 2.0, b", ["Apache-2.0"]), ("Licensed under: CC BY-NC 4.0", ["CC-BY-NC-4.0"])])
def test_license_needs_its_deciding_words(text, names):
    assert [f[0] for f in license_scan.scan(text, license_scan.index(tuple(license_scan.TEMPLATES.items())))] == names


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, "/root/testdata/sf0.1").collect()}
    rows = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet'").fetchall()
    held = [(got[i], y) for i, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(r.held_out for r, _ in held)
    caught = [r.predicted for r, y in held if y == 1]
    assert sum(caught) / len(caught) > 0.8 and sum(r.predicted for r, y in held if y == 0) <= 2


def test_factorization_machine_learns_a_pair():
    """Two terms that are harmless alone and toxic together."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array(sorted(({11} if a else set()) | ({22} if b else set()) | {100 + int(rng.integers(50))})))
        labels.append(float(a and b))
    m = toxicity.fit(rows, np.array(labels))
    at = {int(t): i for i, t in enumerate(m.terms)}
    one, two, both = (m.score(np.array(x)) for x in ([at[11]], [at[22]], [at[11], at[22]]))
    assert both > 0.7 and one < 0.3 and two < 0.3


def test_bpe_equals_the_library(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(1)
    samples = texts[:150] + ["", "a" * 3000, "don't I'LL 12,3 ΑΣ Σς İ ﬁ é", "<|endoftext|> x <|startoftext|>", "\x1c\x85​中文 😀"]
    samples += ["".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(100)) for _ in range(50)]
    for text, (n, ids, decoded) in zip(samples, bpe.Encoder(bpe.load(bpe.default_path())).encode(samples)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want)
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_html_composed_pages_and_oddities():
    model = html_text.train()
    wrong = total = 0
    for nodes, labels in html_text.labelled_pages(60, 123):
        for node, label, p in zip(nodes, labels, model.infer(nodes)[0]):
            wrong, total = wrong + (node.chars > 0 and (p > 0.5) != label), total + (node.chars > 0)
    assert wrong / total < 0.01
    page = ('<body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>one<br>two<p>th\n ree<script>no</script></article>'
            '<div class="comments"><p>first!</p></div><footer>&copy; x</footer>')
    assert html_text.main_text(page, model) == "A & B\none two\nth ree"
    assert html_text.main_text(None, model) == html_text.main_text("", model) == ""
    assert html_text.main_text("only text &lt;", model) == "only text <"
    html_text.main_text("<div>" * 5000 + "deep", model)


@pytest.mark.parametrize("piece", [
    '<svg width="1" />', "<iframe src=x />", "<object/>", "<canvas />", "<datalist><option>no<option>no</datalist>", "<button>", "<noscript>",
    "<p hidden>no", "<ul><li hidden>no<li hidden>no</ul>", "<p hidden>no<div></div>", "<svg><svg/>no</svg>", "<script>no", "<script src=x />",
    "<b><span hidden>no</b></span>", "<iframe src=http://x/></iframe>", "<div style='color:red; DISPLAY : none'>no</div>",
    '<div aria-hidden="true">no<div>no</div>no</div>', "<div class='a'hidden>no</div>", "<button>no<span>no</span></button>"])
def test_html_skips_no_more_than_the_element(piece):
    page = f"<body><article><h1>Head</h1><p>one two three{piece}<p>four five six</p><p>seven</p></article></body>"
    text = "\n".join(t for _, t in html_text.parse(page)[1])
    assert text == "Head\none two three\nfour five six\nseven"


@pytest.mark.parametrize("attributes", ['title="the hidden valley"', "data-css='display: none'", 'title="aria-hidden=true"', 'style="x-display:none"',
                                        'aria-hidden="false"', "class=hidden", 'title="a" alt=hidden'])
def test_html_hides_by_the_attribute_names(attributes):
    assert [t for _, t in html_text.parse(f"<div {attributes}>shown</div>")[1]] == ["shown"]


def fingerprint(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, texts):
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (502, "a b"), (503, texts[3])]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    codes = {i: fingerprint(t) for i, t in rows}
    assert all(got[i].fp & (2**64 - 1) == c for i, c in codes.items())
    root = {i: i for i in codes}
    for _ in range(10):
        for i in codes:
            root[i] = min(root[j] for j in codes if (codes[i] ^ codes[j]).bit_count() <= 4)
    assert {i: r.component_id for i, r in got.items()} == root


def test_pii_base_patterns_and_added_spans():
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def plain(text):
        out = []
        for kind, p in enumerate(patterns):
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m.group())
                if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m.group().split("."))
                        or kind == 2 and 14 <= len(digits) <= 19 and pii.luhn(digits) or kind == 3 and 10 <= len(digits) <= 15):
                    out.append((m.start(), kind, m.end()))
        return sorted(out)

    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("1234.@+- ()ab0") for _ in range(50))
        assert pii.base_spans(text) == plain(text)
    detector = pii.train()
    x, y = pii.examples(800, 77)
    p = np.array([detector.probability(r) for r in x.tolist()])
    assert y[p >= pii.PRECISION].mean() > 0.95 and (p[y == 1] >= pii.PRECISION).mean() > 0.6
    base, every = detector.spans("tel. 555-123-4567, jo@example.org, order 12-34-567")
    assert [pii.KINDS[k] for _, k, _ in base] == ["email"] and [pii.KINDS[k] for _, k, _ in every] == ["phone", "email"]
    assert pii.redact("a jo@x.org b", pii.base_spans("a jo@x.org b")) == "a [EMAIL] b"


def test_mixing_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "small" if i < 5 else "big" if i < 400 else None) for i in range(600)],
                                 "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    for source in ("small", "big", None):
        rows = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 7 and rows[0].target <= 3 * rows[0].source_size
        assert all(r.taken <= 3 * r.size for r in rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs).collect())) if all(r.source for r in got) else True
    copies = {r.doc_id: r.copies for r in got}
    drawn = {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert drawn == {i: n for i, n in copies.items() if n}


@pytest.mark.parametrize("name", ["simhash", "bpe", "pii", "mixing", "license", "toxicity"])
def test_odd_documents(spark, odd, empty, name):
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    run = {"simhash": simhash.near_duplicates, "bpe": bpe.encode_texts, "pii": pii.find, "mixing": mixing.mix, "license": license_scan.find,
           "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels))}[name]
    rows = run(odd).collect()
    assert len(rows) == 10 and sum(r.doc_id is None for r in rows) == 1
    assert len({json.dumps([x for x in r if not isinstance(x, float)], default=str) for r in rows if r.doc_id == 5}) == 1
    assert run(empty).count() == 0


@pytest.mark.parametrize("run", [simhash.fingerprints, bpe.encode_texts, pii.find, license_scan.find, suffix_dedup.dedup])
def test_large_ids_next_to_null_ids(spark, run):
    docs = spark.createDataFrame([(2**53 + 1, "one two"), (None, "three")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in run(docs).collect()} == {2**53 + 1, None}


def test_large_page_ids_next_to_null_ids(spark):
    pages = spark.createDataFrame([(2**53 + 1, None, "<p>a"), (None, None, None)], "page_id long, url string, html string").coalesce(1)
    assert {r.page_id for r in html_text.extract(pages).collect()} == {2**53 + 1, None}


# ---- notices next to each other, bit rows, extra columns -------------------------------------------------------------

@pytest.mark.parametrize("times", [1, 2, 3, 500])
def test_notices_next_to_each_other_are_all_found(times):
    notice = "Released under the MIT License. "
    found = license_scan.scan(notice * times, license_scan.index(tuple(license_scan.TEMPLATES.items())))
    assert [a for _, a, _, _ in found] == [i * len(notice) for i in range(times)]


def test_bit_rows_tell_whether_an_earlier_leaf_is_shared():
    rng = np.random.default_rng(2)
    held = [np.sort(rng.choice(300, 12, replace=False)) for _ in range(80)]
    leaves = np.array([[*h, -1] for h in held], np.int32)
    x, y = tree_forest._earlier_bits(leaves[:30], leaves[30:], 150)
    got = (x[:, None] & y[None]).any(2)
    want = [[bool({*a[a < 150]} & {*b[b < 150]}) for b in held[30:]] for a in held[:30]]
    assert got.tolist() == want
