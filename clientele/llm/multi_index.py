"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes: vectors are turned by rotations that are learned so that the signs lose
least (iterative quantization), several rotations giving ``BITS`` bits. They
are fitted on a bounded sample (``SAMPLE`` vectors, smallest hash of the id
first). Codes are cut into substrings of eight bits and each substring is
indexed: for every value of a substring, a bitmap of the codes in a block whose
substring lies within its share of the radius. By the pigeonhole principle a
code within Hamming radius R of a query is within R // m of it in at least one
of the m substrings (in the first R % m + 1 substrings with that share, in the
others with one less), so the union of one bitmap per substring holds every
such code. Codes found are checked for their full distance, and what remains
is ranked by the inner product of the original vectors in double precision.

The radius is learned too: it covers the share ``COVERED`` of the true nearest
neighbours among the sample. A query that finds fewer than k codes in a block
widens its radius there until it has k or the block is exhausted, so every
query gets k results if there are so many candidates.

Rows are indexed in blocks of bounded size, and every query visits every block
(queries are a stated share of the rows). Each visit returns its k best.

Defined results: vectors that are null, zero or with null or non-finite
components take no part as query or candidate, nor do rows with a null id;
vectors of different lengths have no inner product, so each length is searched
by itself, with codes of its own; ties go to the smaller id; a product beyond
the range of a double is infinite, and one that is no number ranks last;
repeated rows with the query's own id are not candidates, other repeated rows
are as many candidates; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import truncate

BITS = 256
SAMPLE = 4096
COVERED = 0.985
BLOCK = 8192
QUERY_BLOCK = 8192  # every candidate is copied once for so many queries


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the vectors that take part, as double arrays."""
    v = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component goes first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def products(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the rows with ``y``, and what they rank by."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = x @ y
    return score, np.where(np.isnan(score), -np.inf, score)


@dataclass
class Codes:
    """Rotations of the normalised vectors and the radius of the search."""

    rotations: np.ndarray  # dimensions x bits
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(unit_rows(x) @ self.rotations > 0, axis=1)


def fit(sample: np.ndarray, k: int = 20, bits: int = BITS, covered: float = COVERED, seed: int = 3) -> Codes:
    """Iterative quantization for each group of as many bits as dimensions, then the radius."""
    rng = np.random.default_rng(seed)
    unit = unit_rows(sample)
    d, parts = unit.shape[1], []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(20):
            u, _, vt = np.linalg.svd(np.where(unit @ r > 0, 1.0, -1.0).T @ unit)
            r = (u @ vt).T
        parts.append(r)
    codes = Codes(np.concatenate(parts, axis=1)[:, :bits], bits)
    packed, probe = codes.encode(sample), np.arange(0, len(sample), max(1, len(sample) // 512))
    near = []
    for i in probe.tolist():
        s = products(sample, sample[i])[1]
        s[i] = -np.inf
        top = np.argsort(-s, kind="stable")[:min(k, len(s) - 1)]
        near.append(np.bitwise_count(packed[top] ^ packed[i]).sum(1))
    if near and sum(map(len, near)):
        codes.radius = int(np.quantile(np.concatenate(near), covered, method="higher"))
    return codes


_NEAR = [np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None]) <= r for r in range(9)]


class Block:
    """The substring index of one block of codes."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.words = packed.view(np.uint64)
        self.bitmaps: dict[tuple[int, int, int], np.ndarray] = {}

    def _bitmap(self, part: int, value: int, radius: int) -> np.ndarray:
        key = part, value, radius
        if key not in self.bitmaps:
            self.bitmaps[key] = np.packbits(_NEAR[radius][value][self.packed[:, part]], bitorder="little")
        return self.bitmaps[key]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of every code within the radius."""
        m = len(code)
        share, extra = divmod(radius, m)
        found = np.zeros(-(-len(self.packed) // 8), np.uint8)
        for part, value in enumerate(code.tolist()):
            r = min(8, share if part <= extra else share - 1)
            if r >= 0:
                found |= self._bitmap(part, value, r)
        at = np.flatnonzero(np.unpackbits(found, count=len(self.packed), bitorder="little"))
        return at[np.bitwise_count(self.words[at] ^ code.view(np.uint64)).sum(1) <= radius]


def search_block(codes: Codes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 k: int) -> list[tuple[int, int, float]]:
    """(query, id, score): the k best of the block for each query, of what the index finds."""
    block, probes, out = Block(codes.encode(vectors)), codes.encode(queries), []
    step = max(1, codes.rotations.shape[1] // 32)
    for q, x, code in zip(query_ids.tolist(), queries, probes):
        radius = codes.radius
        while True:
            at = block.within(code, radius)
            at = at[ids[at] != q]
            if len(at) >= k or radius >= codes.rotations.shape[1]:
                break
            radius += step
        score, ranked = products(vectors[at], x)
        if len(at) > k:  # everything that ties with the k-th stays for the tie rule
            keep = ranked >= np.partition(ranked, len(ranked) - k)[len(ranked) - k]
            at, score, ranked = at[keep], score[keep], ranked[keep]
        order = np.lexsort((ids[at], -ranked))[:k]
        out += [(q, int(ids[at[i]]), float(score[i])) for i in order]
    return out


def learn(rows: DataFrame, k: int = 20) -> Codes:
    """Fit on the bounded sample of rows of one length."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    return fit(np.stack(sample.vec.to_list()), k)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each vector whose id is divisible by ``every``."""
    rows = truncate(usable(vectors))
    # one row per length of vector; a model gives one or two
    lengths = {r.d: r.n for r in rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    best = None
    for d, n in sorted(lengths.items()):
        found = _nearest_of_length(rows.where(F.size("vec") == d), d, n, k, every)
        best = found if best is None else best.unionByName(found)
    if best is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranked = F.nanvl("score", F.lit(float("-inf")))
    by_query = Window.partitionBy("query_id", "_d").orderBy(ranked.desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _nearest_of_length(rows: DataFrame, d: int, n: int, k: int, every: int) -> DataFrame:
    """(_d, query_id, vec_id, score): the k nearest of each block, from ``n`` vectors of ``d`` components."""
    model = rows.sparkSession.sparkContext.broadcast(learn(rows, k))  # dimensions x bits numbers
    blocks = max(1, -(-n // BLOCK))
    query_blocks = max(1, -(-n // (every * QUERY_BLOCK)))
    placed = rows.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    candidates = placed.select("vec_id", "vec", "b", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("g"),
                               F.lit(False).alias("asks"))
    asked = (rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
             .withColumn("g", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int"))
             .select("vec_id", "vec", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "g", F.lit(True).alias("asks")))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame.asks.to_numpy(bool)
        ids, x = frame.vec_id.to_numpy(), np.stack(frame.vec.to_list()) if len(frame) else np.zeros((0, d))
        found = search_block(model.value, ids[~asks], x[~asks], ids[asks], x[asks], k) if asks.any() and not asks.all() else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = candidates.unionByName(asked).groupBy("b", "g").applyInPandas(compare, "query_id long, vec_id long, score double")
    return found.withColumn("_d", F.lit(d))
