"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its lower-cased words and, for longer words, their first
four and five letters, hashed into ``HASH_BITS`` bits; a term counts once per
text. A linear weight per term cannot tell an insult from an insult next to
the mention of a group; the factorization machine learns a weight for every
pair of terms as the inner product of their factors.

Training rows are a bounded sample of labelled rows (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN``, smallest hash of the id first, so reruns agree). Terms are
screened by how differently the two classes hold them; the machine is fitted
to the screened terms by Adam. Scoring reads every whole text.

Defined results: a null text scores as an empty one, which gets the score of a
text without any term; a null label or id is not learnt from; an id with
several labels counts as toxic if one of them says so; repeated rows get equal
scores; an empty table gives an empty result. Without labels of both kinds
every score is the share of toxic labels (0 without labels). Other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 20
SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
SCREENED = 4096
SCREEN_Z = 4.0
FACTORS = 4
BALANCE = 0.5  # toxic rows weigh at least this share of the clean ones together
ROUNDS = 300
THRESHOLD = 0.7
CACHED_WORDS = 300_000
_WORD = re.compile(r"\w+")


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of one lower-cased word."""
    terms = [_bucket(word)]
    if len(word) > 5:
        terms += [_bucket("^" + word[:4]), _bucket("^" + word[:5])]
    return tuple(terms)


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Machine:
    """bias + linear weights + pair weights from factors, for the screened terms."""

    terms: np.ndarray  # sorted
    weights: np.ndarray
    factors: np.ndarray  # terms x FACTORS
    bias: float

    def score(self, held: np.ndarray) -> float:
        """Probability for the positions (in ``terms``) of the terms a text holds."""
        v = self.factors[held]
        total = v.sum(0)
        x = self.bias + self.weights[held].sum() + 0.5 * float((total * total - (v * v).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def screen(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Terms whose share differs between the classes by ``SCREEN_Z`` standard errors, the clearest ``SCREENED`` of them."""
    size, n1, n0 = 1 << HASH_BITS, int(toxic.sum()), int((toxic == 0).sum())
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    label = np.repeat(toxic, [len(r) for r in rows])
    a, b = np.bincount(flat[label == 1], minlength=size), np.bincount(flat[label == 0], minlength=size)
    p = (a + b + 1) / (n1 + n0 + 2)
    z = np.abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    clear = np.flatnonzero(z >= SCREEN_Z)
    return np.sort(clear[np.argsort(-z[clear], kind="stable")[:SCREENED]])


def fit(rows: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the logistic loss with an L2 penalty, all rows in each step."""
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), float(np.log(share / (1 - share))))
    terms = screen(rows, toxic)
    held = [np.searchsorted(terms, np.intersect1d(r, terms)) for r in rows]
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    col = np.concatenate(held).astype(np.int64)
    by_col = np.argsort(col, kind="stable")
    row_c, n, m, k = row[by_col], len(held), len(terms), FACTORS
    present, first_c = np.unique(col[by_col], return_index=True)
    rows_in, first_r = np.unique(row, return_index=True)

    def sum_rows(x):
        out = np.zeros((n, *x.shape[1:]))
        if len(x):
            out[rows_in] = np.add.reduceat(x, first_r, axis=0)
        return out

    def sum_cols(x):
        out = np.zeros((m, *x.shape[1:]))
        if len(x):
            out[present] = np.add.reduceat(x, first_c, axis=0)
        return out

    weight = np.where(toxic == 1, max(1.0, BALANCE * (n - toxic.sum()) / toxic.sum()), 1.0)
    weight /= weight.sum()
    rng = np.random.default_rng(seed)
    theta = {"w": np.zeros(m), "v": rng.normal(0, 0.05, (m, k)), "b": np.array(0.0)}
    moment = {p: [np.zeros_like(x), np.zeros_like(x)] for p, x in theta.items()}
    for step in range(1, ROUNDS + 1):
        v = theta["v"][col]
        total = sum_rows(v)
        x = theta["b"] + sum_rows(theta["w"][col]) + 0.5 * ((total * total).sum(1) - sum_rows((v * v).sum(1)))
        g = (1 / (1 + np.exp(-np.clip(x, -35, 35))) - toxic) * weight
        pulled = sum_cols(g[row_c])
        grads = {"b": g.sum(), "w": pulled + 2e-5 * theta["w"],
                 "v": sum_cols(g[row_c, None] * total[row_c]) - pulled[:, None] * theta["v"] + 2e-4 * theta["v"]}
        for p, grad in grads.items():
            m1, m2 = moment[p]
            m1[...] = 0.9 * m1 + 0.1 * grad
            m2[...] = 0.999 * m2 + 0.001 * grad * grad
            theta[p] = theta[p] - 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, theta["w"], theta["v"], float(theta["b"]))


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learnt from; a null id has no label and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN)).select(F.col("doc_id").alias("_id"), "toxic")
    # the sample is bounded by its two limits
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))

    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame.doc_id, "toxic": frame.toxic, "terms": [
                np.array(sorted({t for w in text_words(x) for t in word_terms(w)}), np.int32) for x in frame.text]})

    rows = (joined.select("doc_id", "text", F.col("toxic").cast("int"))
            .mapInPandas(terms, "doc_id long, toxic int, terms array<int>")
            .toPandas().sort_values(["doc_id", "toxic"], kind="stable"))
    return fit(rows.terms.tolist(), rows.toxic.to_numpy(float))


class Scorer:
    def __init__(self, machine: Machine, cached: int = CACHED_WORDS):
        self.machine, self.cached = machine, cached
        self.at = {int(t): i for i, t in enumerate(machine.terms)}
        self.seen: dict[str, tuple[int, ...]] = {}

    def score(self, text: str | None) -> float:
        held: set[int] = set()
        words = text_words(text)
        if len(self.seen) > self.cached:
            self.seen = {}
        seen = self.seen
        for w in words:
            at = seen.get(w)
            if at is None:
                at = seen[w] = tuple(self.at[t] for t in word_terms(w) if t in self.at)
            if at:
                held.update(at)
        return self.machine.score(np.array(sorted(held), np.int64))


def score(docs: DataFrame, machine: Machine, columns: list[str] | None = None) -> DataFrame:
    """The columns (``doc_id`` by default) of each row with its score, from the text alone."""
    columns = columns or ["doc_id"]
    handle = docs.sparkSession.sparkContext.broadcast(machine)  # at most SCREENED terms

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(handle.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return docs.select(*columns, rate("text").alias("_score"))


def rejected(score_: F.Column, threshold: float = THRESHOLD) -> F.Column:
    return (score_ >= threshold).cast("int")
