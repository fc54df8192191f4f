"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius.

Fingerprints: words of the lower-cased text, shingles of four words with
repeats, XXH64 with seed 42 of each shingle; a bit is set if it is set in more
than half of the hashes.

Linking: equal fingerprints collapse first. Two fingerprints with at most four
differing bits agree in at least two of six bit blocks, so each fingerprint is
put under its 15 pairs of blocks (21 bits or more each). Under one key the
fingerprints are stored as bit planes, 64 fingerprints to a machine word. The
distances of one fingerprint to all of them are updated plane by plane in
carry-save bitwise counters; a word of 64 fingerprints is abandoned once all
of them exceed the radius. A key with more than ``BLOCK`` fingerprints is cut
into blocks, and pairs of blocks are compared in separate tasks. Each
comparison returns a forest over its fingerprints, never the pairs.

Defined results: a null, empty or blank text has no words and the fingerprint
zero, which is linked like any other; fewer than four words make one shingle;
null ids take no part in a component's smallest id; repeated rows get equal
results; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import as_text, components, with_long
from clientele.session import truncate

SHINGLE = 4
SEED = 42
RADIUS = 4
BIT_BLOCKS = 6
AGREE = 2
BLOCK = 8192
TEXT_BATCH = 2_000_000  # characters hashed in one go
#: One byte to the eight counters of its bits, low bit first, eight bits each.
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def xxh64_slices(data: bytes, starts: np.ndarray, sizes: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many slices of one byte string; slices of equal length are hashed together."""
    padded = data + bytes(8)
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
    one = np.frombuffer(padded, np.uint8)
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for members in np.split(order, cuts) if len(order) else []:
        out[members] = _xxh64(eight, four, one, starts[members], int(sizes[members[0]]), seed)
    return out


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (  # fixed values of XXH64
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _xxh64(eight, four, one, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    seed, done = np.uint64(seed), 0
    with np.errstate(over="ignore"):
        if size >= 32:
            lanes = [np.full(len(at), v, np.uint64) for v in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
            while done + 32 <= size:
                for i in range(4):
                    lanes[i] = _rotate(lanes[i] + eight[at + (done + 8 * i)] * _P2, 31) * _P1
                done += 32
            h = _rotate(lanes[0], 1) + _rotate(lanes[1], 7) + _rotate(lanes[2], 12) + _rotate(lanes[3], 18)
            for lane in lanes:
                h = (h ^ _rotate(lane * _P2, 31) * _P1) * _P1 + _P4
        else:
            h = np.full(len(at), seed + _P5, np.uint64)
        h += np.uint64(size)
        while done + 8 <= size:
            h = _rotate(h ^ _rotate(eight[at + done] * _P2, 31) * _P1, 27) * _P1 + _P4
            done += 8
        if done + 4 <= size:
            h = _rotate(h ^ four[at + done].astype(np.uint64) * _P1, 23) * _P2 + _P3
            done += 4
        while done < size:
            h = _rotate(h ^ one[at + done].astype(np.uint64) * _P5, 11) * _P1
            done += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def _slices(line: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the shingles of a line of words with single spaces."""
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(line)]])
    if len(starts) <= size:
        return starts[:1], np.array([len(line)])
    return starts[:len(starts) - size + 1], ends[size - 1:] - starts[:len(starts) - size + 1]


def _majority(hashes: np.ndarray) -> int:
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(columns), 255):  # eight counters in a word do not overflow within 255 rows
        ones += _SPREAD[columns[start:start + 255]].sum(0).view(np.uint8)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints_of(texts: list[str | None], size: int = SHINGLE) -> list[int]:
    # bytes.lower() and bytes.split() know A-Z and the six ASCII spaces only
    lines = [b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split()) for t in texts]
    parts = [_slices(line, size) if line else None for line in lines]
    offset, starts, sizes = 0, [], []
    for line, part in zip(lines, parts):
        if part:
            starts.append(part[0] + offset)
            sizes.append(part[1])
        offset += len(line)
    if not starts:
        return [0] * len(texts)
    hashes = xxh64_slices(b"".join(lines), np.concatenate(starts), np.concatenate(sizes))
    ends = iter(np.cumsum([len(x) for x in sizes]).tolist())
    out, begin = [], 0
    for part in parts:
        if part is None:
            out.append(0)
            continue
        end = next(ends)
        out.append(_majority(hashes[begin:end]))
        begin = end
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, codes, held, load = frame.iloc[:, 1].tolist(), [], [], 0
            for t in texts:
                held.append(t)
                load += len(t or "")
                if load > TEXT_BATCH:
                    codes += fingerprints_of(held)
                    held, load = [], 0
            codes += fingerprints_of(held)
            yield pd.DataFrame({"doc_id": frame.iloc[:, 0], "fp": np.array(codes, np.uint64).view(np.int64)})

    return with_long(docs.select(*as_text("doc_id"), text).mapInPandas(batches, "doc_id string, fp long"), "doc_id")


def bit_planes(codes: np.ndarray) -> np.ndarray:
    """64 rows, one per bit; each a row of machine words over the codes."""
    padded = np.zeros(-(-len(codes) // 64) * 64, np.uint64)
    padded[:len(codes)] = codes
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def within_radius(planes: np.ndarray, valid: np.ndarray, queries: np.ndarray, q: np.ndarray, w: np.ndarray,
                  radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(query, slot) of the codes within the radius, for the given pairs of a query and a machine word of 64 codes.

    ``valid``: the bits of each word that hold a code. A pair is abandoned once all its codes exceed the radius.
    """
    levels = int(radius).bit_length()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    beyond = ~valid[w]
    counters = [np.zeros(len(q), np.uint64) for _ in range(levels)]
    start = (1 << levels) - 1 - radius  # counters start here, so that passing the radius is a carry out
    for i in range(levels):
        if start >> i & 1:
            counters[i][:] = full
    for bit in range(64):
        carry = planes[bit][w] ^ (full * (queries[q] >> np.uint64(bit) & np.uint64(1)))
        for i in range(levels):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        beyond |= carry
        if bit % 4 == 3:
            alive = beyond != full
            if alive.sum() < 0.8 * len(alive):
                q, w, beyond = q[alive], w[alive], beyond[alive]
                counters = [c[alive] for c in counters]
                if not len(q):
                    break
    hits = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pair, lane = np.nonzero(hits)
    return q[pair], w[pair] * 64 + lane


def forest(codes: np.ndarray, group: np.ndarray, second: np.ndarray, cross: np.ndarray, radius: int = RADIUS,
           pairs: int = 32768) -> np.ndarray:
    """Edges (code, smaller code), in rows, that connect what is within the radius in many groups at once.

    ``group``: ascending group number of each code. In a group with ``cross`` the codes that are not ``second`` are
    compared with those that are, in others all with all.
    """
    distinct, node = np.unique(codes, return_inverse=True)
    root = np.arange(len(distinct))
    as_target, as_query = ~cross[group] | second, ~cross[group] | ~second
    rows, groups = np.flatnonzero(as_target), len(cross)
    count = np.bincount(group[rows], minlength=groups)
    words = -(-count // 64)
    offset = np.cumsum(words) - words
    slot = offset[group[rows]] * 64 + np.arange(len(rows)) - (np.cumsum(count) - count)[group[rows]]
    stored, held = np.zeros(int(words.sum()) * 64, np.uint64), np.zeros(int(words.sum()) * 64, bool)
    stored[slot], held[slot] = codes[rows], True
    owner = np.zeros(len(stored), np.int64)
    owner[slot] = node[rows]
    planes, valid = bit_planes(stored), np.packbits(held, bitorder="little").view(np.uint64)
    asking = np.flatnonzero(as_query)
    each = words[group[asking]]
    ends = np.cumsum(each)
    for begin in range(0, int(ends[-1]) if len(ends) else 0, pairs):
        at = np.arange(begin, min(begin + pairs, int(ends[-1])))
        i = np.searchsorted(ends, at, "right")
        q = asking[i]
        q, c = within_radius(planes, valid, codes, q, offset[group[q]] + at - (ends[i] - each[i]), radius)
        a, b = node[q], owner[c]
        differ = a != b
        a, b = a[differ], b[differ]
        while len(a):  # smallest label of both ends, then follow labels
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            if (root == before).all():
                break
    moved = np.flatnonzero(root != np.arange(len(root)))
    return np.stack([distinct[moved], distinct[root[moved]]], axis=1)


def _masks() -> list[np.uint64]:
    bounds = [round(64 * i / BIT_BLOCKS) for i in range(BIT_BLOCKS + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]
    return [np.uint64(part[i] | part[j]) for i, j in combinations(range(BIT_BLOCKS), AGREE)]


def links(codes: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct codes; (fp) in, one row per code."""
    masks = [int(m) if m < 1 << 63 else int(m) - (1 << 64) for m in map(int, _masks())]
    keyed = codes.select("fp", F.posexplode(F.array(*[F.lit(m).bitwiseAND(F.col("fp")) for m in masks])).alias("table", "key"))
    counted = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    split = F.ceil(F.col("n") / BLOCK).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    placed = (keyed.join(counted.withColumn("k", split), ["table", "key"]).withColumn("c", chunk)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
              .select("table", "key", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"),
                      (F.col("c") > F.col("other")).alias("second"), "fp"))

    return _grouped(placed)


def _grouped(placed: DataFrame) -> DataFrame:
    """Forests of all groups (table, key, i, j), many groups to a batch.

    Rows are dealt by key and sorted, so a group is a run of rows; a batch is
    cut at the end of a run, and a run holds at most two blocks.
    """
    keys = ["table", "key", "i", "j"]

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            new = _starts(frame, keys)
            held, done = frame.iloc[new[-1]:], frame.iloc[:new[-1]]
            if len(done):
                yield _edges(done, keys)
        if held is not None:
            yield _edges(held, keys)

    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(runs, "a long, b long")


def _starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), bool)
    new[:1] = True
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _edges(frame: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    starts = _starts(frame, keys)
    group = np.zeros(len(frame), np.int64)
    group[starts[1:]] = 1
    cross = (frame.i.to_numpy() != frame.j.to_numpy())[starts]
    out = forest(frame.fp.to_numpy(np.int64).view(np.uint64), np.cumsum(group), frame.second.to_numpy(bool), cross).view(np.int64)
    return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``."""
    prints = truncate(fingerprints(docs))
    classes = truncate(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = components(links(classes.select("fp")))
    member = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = truncate(member.join(least, "component").select("fp", "component_id"))
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")
