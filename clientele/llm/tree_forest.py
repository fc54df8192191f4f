"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Equal vectors collapse first. Each tree splits its rows again and again along a
random direction at the median of a bounded sample (``SAMPLE`` vectors, fitted
on the driver); rows close to a split, nearer than ``SPILL`` standard
deviations of the projected distance that the similarity allows, go to both
sides. Splitting stops when a leaf is expected to hold ``LEAF`` rows or fewer,
or when a split no longer parts the rows. A tree parts more pairs the deeper it
is, so the number of trees follows the fitted trees: each is tried on pairs
made from the sample at exactly the similarity bound, and trees are added
until the product of the shares that they part is ``MISS`` or less. Within a leaf all pairs are compared
and verified by their cosine in double precision. A leaf that is larger (a
dense group of near copies) is cut into blocks, and pairs of blocks are
compared in separate tasks. A pair found in several leaves counts in the first
leaf, by number, that both vectors share, so every link counts once and no pair
is ever written: each comparison returns one row per vector, with its number
of links and a smaller vector it is connected to.

Defined results: vectors that are null, zero or with null or non-finite
components link with nothing: 0 links, a component of their own; vectors of
different lengths do not link, each length has its own forest; components of
any finite size count, as vectors are scaled by a power of two first; repeated rows of one id are one vector (one
result row per input row); null ids give null results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import components
from clientele.llm.multi_index import usable
from clientele.session import truncate

COSINE = 0.9
TREES = 8  # at least
MOST_TREES = 64
MISS = 1e-4  # share of pairs at the similarity bound that may share no leaf
TRIED = 2048  # pairs that measure it
SAMPLE = 16384
LEAF = 512
BLOCK = 2048
SPILL = 0.4


@dataclass
class Tree:
    """Nodes in order: direction, threshold, children; a leaf has child -1 and a number."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray  # nodes x 2
    leaf: np.ndarray

    def leaves(self, x: np.ndarray, margin: float) -> list[tuple[np.ndarray, int]]:
        """(rows, leaf number) for every leaf that holds rows of ``x``."""
        out, todo = [], [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node, 0] < 0:
                out.append((rows, int(self.leaf[node])))
                continue
            p = x[rows] @ self.directions[node] - self.thresholds[node]
            for side, part in enumerate((rows[p <= margin], rows[p > -margin])):
                if len(part):
                    todo.append((int(self.children[node, side]), part))
        return out


def margin(dimensions: int, cosine: float = COSINE, spill: float = SPILL) -> float:
    """``spill`` standard deviations of the projected distance of a pair at the similarity bound."""
    return spill * np.sqrt((2 - 2 * cosine) / dimensions)


def fit(sample: np.ndarray, share: float, first_leaf: int, seed: int, width: float, leaf_rows: int = LEAF) -> Tree:
    """A tree for unit vectors; ``share``: rows that one sample row stands for."""
    rng = np.random.default_rng(seed)
    directions, thresholds, children, leaf = [], [], [], []
    todo, numbers = [(np.arange(len(sample)), -1, 0)], first_leaf
    while todo:
        rows, parent, side = todo.pop()
        at = len(directions)
        if parent >= 0:
            children[parent][side] = at
        direction = rng.normal(size=sample.shape[1])
        direction /= np.linalg.norm(direction)
        p = sample[rows] @ direction
        cut = float(np.median(p)) if len(rows) else 0.0
        directions.append(direction)
        thresholds.append(cut)
        children.append([-1, -1])
        leaf.append(-1)
        left, right = rows[p <= cut + width], rows[p > cut - width]
        parted = max(len(left), len(right)) <= 0.8 * len(rows)
        if len(rows) * share > leaf_rows and len(rows) >= 16 and parted:
            todo += [(left, at, 0), (right, at, 1)]
        else:
            leaf[at] = numbers
            numbers += 1
    return Tree(np.array(directions), np.array(thresholds), np.array(children), np.array(leaf))


def pairs_at(unit: np.ndarray, cosine: float = COSINE, seed: int = 23) -> np.ndarray:
    """For each unit vector another one at exactly this cosine, in a random direction."""
    other = np.random.default_rng(seed).normal(size=unit.shape)
    other -= (other * unit).sum(1, keepdims=True) * unit
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
    return cosine * unit + np.sqrt(1 - cosine * cosine) * other


def missed(tree: Tree, x: np.ndarray, y: np.ndarray, width: float) -> np.ndarray:
    """Which rows share no leaf of the tree with the same row of ``y``."""
    apart = np.ones(len(x), bool)
    of_y = {leaf: rows for rows, leaf in tree.leaves(y, width)}
    for rows, leaf in tree.leaves(x, width):
        if leaf in of_y:
            apart[np.intersect1d(rows, of_y[leaf])] = False
    return apart


def grow(sample: np.ndarray, n: int, trees: int = TREES, seed: int = 17, miss: float = MISS) -> list[Tree]:
    """``trees`` or as many more as it takes until pairs at the similarity bound are expected to miss each other with ``miss``."""
    out: list[Tree] = []
    width, lost = margin(sample.shape[1]), 1.0
    x = sample[:TRIED]
    y = pairs_at(x)
    while len(out) < trees or lost > miss and len(out) < MOST_TREES:
        first = 1 + int(out[-1].leaf.max()) if out else 0
        out.append(fit(sample, n / max(1, len(sample)), first, seed + len(out), width))
        lost *= float(missed(out[-1], x, y, width).mean()) if sample.shape[1] > 1 else 0.0
    return out


def _earlier_bits(leaves_x: np.ndarray, leaves_y: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit rows of the leaves before ``leaf`` that each row holds, over those that several rows hold."""
    both = np.concatenate([leaves_x, leaves_y])
    row, column = np.nonzero((both >= 0) & (both < leaf))
    names, at, times = np.unique(both[row, column], return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    shared = times[at] > 1
    row, bit = row[shared], place[at[shared]]
    bits = np.zeros((len(both), int((times > 1).sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    return bits[:len(leaves_x)], bits[len(leaves_x):]


def compare(x: np.ndarray, y: np.ndarray, same: bool, leaf: int, leaves_x: np.ndarray, leaves_y: np.ndarray,
            cosine: float = COSINE, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs that link and whose first shared leaf is this one."""
    found_i, found_j = [], []
    bits_x, bits_y = _earlier_bits(leaves_x, leaves_y, leaf)
    step = max(1000, 4_000_000 // bits_x.shape[1])
    for start in range(0, len(x), rows):
        near = x[start:start + rows] @ y.T >= cosine
        if same:
            near &= np.arange(start, start + len(near))[:, None] < np.arange(len(y))[None]
        i, j = np.nonzero(near)
        for a in range(0, len(i), step):
            p, q = i[a:a + step] + start, j[a:a + step]
            first = ~(bits_x[p] & bits_y[q]).any(1)
            found_i.append(p[first])
            found_j.append(q[first])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.zeros(0, int), np.zeros(0, int))


def _links(frame: pd.DataFrame) -> pd.DataFrame:
    """(rep, n, root) for every vector with a link in this comparison."""
    second = frame.second.to_numpy(bool)
    leaf, same = int(frame.leaf.iloc[0]), frame.i.iloc[0] == frame.j.iloc[0]
    x = np.frombuffer(b"".join(frame.unit), np.float64).reshape(len(frame), -1)
    rows = frame.leaves.to_list()
    held = np.full((len(rows), max(map(len, rows))), -1, np.int32)
    for r, values in enumerate(rows):
        held[r, :len(values)] = values
    ids, copies = frame.rep.to_numpy(), frame.copies.to_numpy()
    left = np.flatnonzero(~second)
    right = left if same else np.flatnonzero(second)
    i, j = compare(x[left], x[right], same, leaf, held[left], held[right])
    a, b = left[i], right[j]
    n = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    by_rank, root = np.sort(ids), np.arange(len(ids))
    a, b = rank[a], rank[b]
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    linked = np.flatnonzero(n > 0)
    return pd.DataFrame({"rep": ids[linked], "n": n[linked].astype(np.int64), "root": by_rank[root[rank[linked]]]})


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(largest)))  # exact, so cosines do not change
    valid = (usable(vectors, vec_id, embedding).withColumn("_scale", scale)
             .select("vec_id", F.transform("vec", lambda x: x / F.col("_scale")).alias("vec"))
             .groupBy("vec_id").agg(F.min("vec").alias("vec")))
    copies = truncate(valid.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    every_id = vectors.select(F.col(vec_id).cast("long").alias("vec_id"))
    # one row per length of vector; a model gives one or two
    lengths = {r.d: r.n for r in copies.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).where("n > 1").collect()}
    found = None
    for d, n in sorted(lengths.items()):
        links = truncate(_links_of_length(copies.where(F.size("vec") == d), d, n))
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = copies.sparkSession.createDataFrame([], "rep long, n long, root long")
    counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_copy = truncate(copies.join(counted, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("vec").alias("_vec"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")))
    member = truncate(valid.join(per_copy, F.col("vec") == F.col("_vec")).select(
        F.col("vec_id").alias("_id"), "n_links", "component_id"))
    own = F.coalesce("component_id", "vec_id")
    return every_id.join(member, F.col("vec_id") == F.col("_id"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        (F.col("vec_id") == own).alias("kept"))


def _links_of_length(copies: DataFrame, d: int, n: int) -> DataFrame:
    """(rep, n, root) per comparison, from the ``n`` distinct vectors of ``d`` components."""
    sample = copies.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toPandas()
    unit = np.stack(sample.vec.to_list())
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    model, width = copies.sparkSession.sparkContext.broadcast(grow(unit, n)), margin(d)  # bounded by the sample

    @F.pandas_udf("leaves array<int>, unit binary")
    def leaves_of(vec: pd.Series) -> pd.DataFrame:
        if not len(vec):
            return pd.DataFrame({"leaves": [], "unit": []})
        x = np.stack(vec.to_list())
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        out: list[list[int]] = [[] for _ in range(len(x))]
        for tree in model.value:
            for rows, leaf in tree.leaves(x, width):
                for r in rows.tolist():
                    out[r].append(leaf)
        return pd.DataFrame({"leaves": [np.array(sorted(leaves), np.int32) for leaves in out],
                             "unit": [row.tobytes() for row in x]})

    placed = truncate(copies.withColumn("_l", leaves_of("vec")).select("rep", "copies", "_l.leaves", "_l.unit"))
    each = placed.withColumn("leaf", F.explode("leaves"))
    sizes = each.groupBy("leaf").agg(F.count("*").alias("_n")).withColumn("k", F.ceil(F.col("_n") / BLOCK).cast("int"))
    # one row per leaf: bounded by the sample the trees are fitted on
    tasks = (each.join(F.broadcast(sizes.where("_n > 1").select("leaf", "k")), "leaf")
             .withColumn("c", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select("leaf", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"),
                     (F.col("c") > F.col("other")).alias("second"), "rep", "copies", "unit", "leaves"))
    return tasks.groupBy("leaf", "i", "j").applyInPandas(_links, "rep long, n long, root long")
