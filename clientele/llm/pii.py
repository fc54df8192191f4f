"""Personal data: base patterns, and further spans chosen by boosted trees.

The base patterns (e-mail, IPv4 address, payment card, international phone)
always count. High-recall generators propose further spans that the patterns
do not cover: spelled-out e-mail addresses, IPv6 addresses, cards grouped by
other signs, national phone numbers. Proposals may overlap. Gradient-boosted
trees score each by its format and its context; per kind, the scores are
calibrated on held-out examples and a proposal is selected if its calibrated
probability reaches ``PRECISION``. The trees are trained here, on examples
composed from formats of the four kinds and of look-alikes (order numbers,
dates, versions, measures, times, hashes).

Defined results: a null or empty text has no spans; offsets are code points,
end exclusive; repeated rows get equal results; an empty table gives an empty
result; other columns are not read. All scans are linear in the text.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import as_text, with_long

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.97
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns in the order of start, then kind."""
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, 0, found.end()))
        free = found.end() if found else at + 1
        at = text.find("@", free)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


_AT = r"(?:\(at\)|\[at\]|\{at\}|(?<=\s)at(?=\s))"
_DOT = r"(?:\.|\(dot\)|\[dot\]|\{dot\}|(?<=\s)dot(?=\s))"
_GENERATORS = (
    (0, re.compile(rf"(?<![\w.+-])[\w.+-]{{1,64}}\s?{_AT}\s?[\w-]{{1,63}}(?:\s?{_DOT}\s?[\w-]{{2,63}}){{1,4}}"),
     re.compile(r"[\[({]at[\])}]|\sdot\s|[\[({]dot[\])}]")),
    (1, re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])"), re.compile(r"[0-9A-Fa-f]*:[0-9A-Fa-f]*:")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])"), re.compile(r"[0-9]{4}[./_][0-9]{4}")),
    (3, re.compile(r"(?<![\w+])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{2,5}(?:[ .-][0-9]{2,4})?(?!\w)"), re.compile(r"[0-9]\)?[ .-][0-9]{2}")),
)
_HINTS = tuple(re.compile(p) for p in (
    r"phone|tel\b|tel\.|call|mobile|fax|ring|whatsapp", r"mail|write|contact|reach", r"card|visa|master|amex|credit|pay",
    r"\bip\b|host|server|address|ping|gateway", r"order|invoice|ref|number|\bno\b|isbn|sku|ticket|case|part",
    r"version|release|build|\bv\b", r"date|on\b|since|until|born", r"time|clock|took|duration|\bat\b", r"hash|commit|key|mac\b|sum"))
CONTEXT = 28


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every generator's matches; they may overlap."""
    out = []
    for kind, pattern, needs in _GENERATORS:
        if needs.search(text):
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return out


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    span, before = text[start:end], text[max(0, start - CONTEXT):start].lower()
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    digits = re.sub("[^0-9]", "", span)
    joined = re.sub("[^A-Za-z0-9]", "", span)
    signs = [span.count(c) for c in " .-()[]:/_"]
    prev, nxt = text[start - 1:start], text[end:end + 1]
    words = [len(w) for w in re.findall(r"[^\W\d_]+", span)] or [0]
    return [kind, len(span), len(digits), len(joined) - len(digits), *signs, len(groups), groups[0], groups[-1], max(groups), min(groups),
            float(len(digits) > 1 and luhn(digits)), float("at" in span.lower()), float("dot" in span.lower()), max(words), words[-1],
            float(prev.isspace() or not prev), float(prev in "([{<\"'"), float(nxt.isspace() or not nxt), float(nxt in ".,;)]}>"),
            *[float(bool(h.search(before))) for h in _HINTS]]


# --- boosted trees ---------------------------------------------------------------------------------------------------

@dataclass
class Trees:
    """Depth-limited regression trees as flat arrays; a sum of leaf values is a log-odds."""

    start: float
    trees: list[list[tuple]]  # nodes: (feature, threshold, left, right) or (value,)

    def raw(self, x: list[float]) -> float:
        total = self.start
        for nodes in self.trees:
            node = nodes[0]
            while len(node) > 1:
                node = nodes[node[2] if x[node[0]] <= node[1] else node[3]]
            total += node[0]
        return total


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2) -> Trees:
    """Newton boosting of the logistic loss with exact splits."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(p / (1 - p))), [])
    margin = np.full(len(y), model.start)
    cuts = [np.unique(x[:, f])[:-1] for f in range(x.shape[1])]
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = y - prob, np.maximum(prob * (1 - prob), 1e-6)
        nodes: list[tuple] = []

        def grow(rows: np.ndarray, left: int) -> int:
            at = len(nodes)
            nodes.append(())
            gs, hs = g[rows].sum(), h[rows].sum()
            best, gain = None, 1e-6
            if left and len(rows) >= 20:
                for f, values in enumerate(cuts):
                    for c in values:
                        low = x[rows, f] <= c
                        gl, hl = g[rows][low].sum(), h[rows][low].sum()
                        if 5 <= low.sum() <= len(rows) - 5:
                            now = gl**2 / (hl + 1) + (gs - gl)**2 / (hs - hl + 1) - gs**2 / (hs + 1)
                            if now > gain:
                                best, gain = (f, c), now
            if best is None:
                nodes[at] = (float(rate * gs / (hs + 1)),)
                margin[rows] += nodes[at][0]
            else:
                low = x[rows, best[0]] <= best[1]
                a, b = grow(rows[low], left - 1), grow(rows[~low], left - 1)
                nodes[at] = (int(best[0]), float(best[1]), a, b)
            return at

        grow(np.arange(len(y)), depth)
        model.trees.append(nodes)
    return model


def calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels to the raw scores."""
    a, b = 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g, w = target - p, np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(w * raw * raw).sum() + 1e-6, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, np.array([(g * raw).sum(), g.sum()]))
        a, b = a + float(step[0]), b + float(step[1])
    return a, b


# --- composed training examples ------------------------------------------------------------------------------------

def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("aeioulnrstdmpch") for _ in range(rng.randint(2, 9)))


def _card_number(rng: random.Random, good: bool) -> str:
    while True:
        d = _digits(rng, 16)
        if luhn(d) == good:
            return d


def _example(rng: random.Random) -> tuple[str, str, bool]:
    """(text before, span, whether it is personal data)."""
    d, w, pick = (lambda n: _digits(rng, n)), (lambda: _word(rng)), rng.randrange(16)
    ctx = lambda *c: rng.choice([*c, w(), w()])  # noqa: E731  half of the contexts say nothing
    sep = rng.choice(" .-")
    if pick == 0:
        return ctx("phone", "call", "tel.", "mobile"), f"({d(3)}){rng.choice(' -')}{d(3)}-{d(4)}", True
    if pick == 1:
        return rng.choice(["phone", "call me at", "tel.", "fax", "mobile"]), f"{d(3)}{sep}{d(3)}{sep}{d(4)}", True
    if pick == 2:
        return rng.choice(["phone", "tel.", "ring", "fax"]), f"0{d(2)}{sep}{d(4)}{sep}{d(4)}", True
    if pick == 3:
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", "."), (" [at] ", " [dot] "), ("[at]", ".")])
        return ctx("mail", "write to", "contact"), f"{w()}{rng.choice(['', '.' + w()])}{at}{w()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'io'])}", True
    if pick == 4:
        return ctx("host", "server", "ip", "ping"), ":".join(f"{rng.randrange(16, 65536):x}" for _ in range(8)), True
    if pick == 5:
        return ctx("host", "address"), f"{rng.choice(['2001', 'fe80', '2a02'])}:{rng.randrange(65536):x}::{rng.randrange(1, 65536):x}", True
    if pick == 6:
        n = _card_number(rng, True)
        return ctx("card", "visa", "pay with"), rng.choice("./_").join(n[i:i + 4] for i in range(0, 16, 4)), True
    if pick == 7:
        n = _card_number(rng, False)
        return ctx("order", "part", "ref"), rng.choice("./_").join(n[i:i + 4] for i in range(0, 16, 4)), False
    if pick == 8:
        return ctx("on", "date", "since"), f"{rng.choice([d(2), '20' + d(2)])}{sep}{rng.randint(1, 12):02d}{sep}{rng.randint(1, 28):02d}", False
    if pick == 9:
        return ctx("order", "invoice", "ref", "case"), f"{d(rng.randint(2, 4))}{sep}{d(rng.randint(2, 4))}{sep}{d(rng.randint(2, 5))}", False
    if pick == 10:
        return ctx("version", "release", "build"), f"{d(2)}.{d(2)}.{d(rng.randint(2, 4))}", False
    if pick == 11:
        return ctx("time", "took", "at"), f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}", False
    if pick == 12:
        return ctx("mac", "key"), ":".join(f"{rng.randrange(256):02x}" for _ in range(rng.choice([3, 4, 6]))), False
    if pick == 13:
        return w(), f"{w()} at {w()}.{w()}", False
    if pick == 14:
        return w(), f"{w()} at {w()} dot {w()}", False
    return w(), sep.join(d(rng.randint(2, 4)) for _ in range(rng.randint(3, 4))), False


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the proposals in composed texts."""
    rng, x, y = random.Random(seed), [], []
    while len(x) < n:
        before, span, personal = _example(rng)
        text = f"{_word(rng)} {_word(rng)} {before} {span}{rng.choice([' ', '. ', ', '])}{_word(rng)} {_word(rng)}"
        at = text.index(span)
        for start, kind, end in proposals(text):
            if start < at + len(span) and end > at:
                x.append(features(text, start, kind, end))
                # a spelled-out address may start a word too early: only whole spans count
                y.append(float(personal and start == at and end == at + len(span)))
    return np.array(x), np.array(y)


@dataclass
class Detector:
    trees: Trees
    slope: float
    offset: float

    def probability(self, x: list[float]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.trees.raw(x) + self.offset, -30, 30))))

    def spans(self, text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans and all spans, each in the order of start, then kind."""
        if not text:
            return [], []
        base, proposed = base_spans(text), proposals(text)
        if not proposed:
            return base, base
        covered = bytearray(len(text))  # a mark per code point, so each test costs the length of one span
        for start, _, end in base:
            covered[start:end] = b"x" * (end - start)
        chosen = []
        for start, kind, end in proposed:
            if covered.find(b"x", start, end) < 0:
                p = self.probability(features(text, start, kind, end))
                if p >= PRECISION:
                    chosen.append((-p, start, kind, end))
        added: list[tuple[int, int, int]] = []
        for _, start, kind, end in sorted(chosen):  # the likelier of two overlapping proposals
            if covered.find(b"x", start, end) < 0:
                covered[start:end] = b"x" * (end - start)
                added.append((start, kind, end))
        return base, sorted(base + added)


@lru_cache(1)
def train(n: int = 1500, seed: int = 11) -> Detector:
    x, y = examples(n, seed)
    trees = boost(x, y)
    held, labels = examples(n // 2, seed + 1)
    slope, offset = calibrate(np.array([trees.raw(r) for r in held.tolist()]), labels)
    return Detector(trees, slope, offset)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row; counts are of base spans."""
    handle = docs.sparkSession.sparkContext.broadcast(detector or train())
    schema = "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = handle.value
        for frame in frames:
            out = []
            for doc_id, text in zip(frame.iloc[:, 0], frame.iloc[:, 1]):
                base, every = model.spans(text)
                count = [sum(k == i for _, k, _ in base) for i in range(4)]
                out.append((doc_id, *count,
                            hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
            yield pd.DataFrame(out, columns=names, dtype=object)

    return with_long(docs.select(*as_text("doc_id"), "text").mapInPandas(batches, schema), "doc_id")


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each covered stretch replaced by [KIND] of its first span."""
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """The rows of ``docs`` with all spans replaced in ``text``; a null text stays null."""
    handle = docs.sparkSession.sparkContext.broadcast(detector or train())

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = handle.value
        for texts in batches:
            yield pd.Series([redact(t, model.spans(t)[1]) for t in texts], dtype=object)

    return docs.withColumn("text", clean("text"))
