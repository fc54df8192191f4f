"""Removal of repeated byte strings of ``LENGTH`` bytes by a sparse, range-partitioned suffix array.

Sparse suffixes. Of all suffixes only those at anchors are sorted: in every
window of LENGTH bytes, the run of ``GRAM`` bytes with the smallest hash (the
leftmost of equal ones). The anchor of a window depends on its bytes alone, so
equal windows have their anchor at the same place, and each window belongs to
exactly one anchor. Anchors whose run occurs once in the corpus are set aside:
their windows cannot repeat. A run that repeats within a batch of a task is
known to repeat and is sent under a spread key, with one probe for all of them,
so a passage that is everywhere does not meet in one task.

Sorting. The other anchors travel with the bytes that their windows cover: the
suffix from the anchor on and the bytes before it. Sampled splitters
range-partition them by the leading bytes of the suffix; equal ones of a task
are merged into the earliest first. Each bucket is sorted by multikey quicksort on eight-byte tokens, once
by suffix and once by the reversed bytes before the anchor. The lengths of the
common prefixes of neighbours then number the distinct prefixes of every
length, and a window is a pair of two such numbers. In each group of equal
windows all but the earliest are removed.

Boundaries. Windows whose suffix part equals that of a splitter may have equals
in the neighbouring buckets. The earliest of each such group leaves its bucket
under a digest of the window, and the digests are compared across buckets.

Order: smaller doc_id, then earlier start; a null id comes before all others.
Defined results: a null or empty text has 0 bytes and the digest of nothing;
texts shorter than LENGTH lose nothing; equal rows get equal results and do not
remove each other; rows that share an id but not the text are told apart
by the 64-bit hash of the text, which travels with the id as ``tag``, and
equal starts in them do not remove each other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.session import truncate

LENGTH = 100
GRAM = 32
BATCH_BYTES = 1_000_000
PIECE_BYTES = 8_000_000  # longer texts are read in pieces
BUCKET_ROWS = 16384
SPLITTER_ROWS = 20_000
_PLACES = LENGTH - GRAM + 1
_NULL_ID = -(1 << 63)
_POSITION = np.uint64((1 << 24) - 1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_WHOLE = 127  # in place of l_lo: the text equals an earlier one of its batch


# --- anchors ---------------------------------------------------------------------------------------------------------

def _gram_hashes(data: bytes, n: int) -> np.ndarray:
    padded = data + bytes(GRAM + 8)
    h = np.zeros(n, np.uint64)
    for j in range(GRAM // 8):
        h += np.ndarray(n, "<u8", padded, offset=8 * j, strides=(1,))
        h *= _MIX[j]
        h ^= h >> np.uint64(32 - 3 * (j % 2))
    return h


def anchors(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, anchor, first window, last window, text) of the texts that lie in ``data`` one after the other."""
    n = len(data)
    long = ends - begins >= LENGTH
    if not long.any():
        return tuple(np.zeros(0, t) for t in (np.uint64, int, int, int, int))
    h = _gram_hashes(data, n)
    low = (h & ~_POSITION) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= _PLACES:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = _PLACES - width
    low = np.minimum(low[:len(low) - rest], low[rest:])
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, begins[long], 1)
    np.add.at(step, ends[long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    at = (low[starts] & _POSITION).astype(np.int64)
    new = np.concatenate([[True], (np.diff(at) != 0) | (np.diff(starts) != 1)])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
    return h[at[new]], at[new], first, last, np.searchsorted(begins, first, "right") - 1


def _pack(at, l_lo, l_hi, known):
    return (at << 15) | (l_lo << 8) | (l_hi << 1) | known


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    return x ^ (x >> np.uint64(29))


def _batch_anchors(docs: np.ndarray, tags: np.ndarray, texts: list[bytes]) -> pd.DataFrame:
    rows = []
    order = np.argsort(docs, kind="stable").tolist()
    seen: dict[bytes, tuple[int, int]] = {}
    pieces, base, owner, runs = [], [], [], [0]  # runs: where each run of at most PIECE_BYTES + LENGTH bytes begins
    load = 0
    for i in order:
        text = texts[i]
        if len(text) < LENGTH:
            continue
        earlier = seen.setdefault(text, (int(docs[i]), int(tags[i])))
        if earlier != (docs[i], tags[i]) and earlier[0] < docs[i]:
            rows.append((int(docs[i]), int(tags[i]), _pack(len(text), _WHOLE, 0, 1)))
            continue
        for o in range(0, len(text) - LENGTH + 1, PIECE_BYTES):
            pieces.append(text[o:o + PIECE_BYTES + LENGTH - 1])
            if load + len(pieces[-1]) > PIECE_BYTES + LENGTH:
                runs.append(len(pieces) - 1)
                load = 0
            load += len(pieces[-1])
            base.append(o)
            owner.append(i)
    parts = []
    for a, b in zip(runs, [*runs[1:], len(pieces)]):  # places within a run fit into _POSITION
        ends = np.cumsum(np.array([len(p) for p in pieces[a:b]], np.int64))
        begins = ends - np.diff(ends, prepend=0)
        key, at, first, last, piece = anchors(b"".join(pieces[a:b]), begins, ends)
        shift = np.array(base[a:b], np.int64)[piece] - begins[piece]
        parts.append((key, at + shift, at - last, at - first, np.array(owner[a:b], np.int64)[piece]))
    key, at, l_lo, l_hi, owner_ = (np.concatenate(x) for x in zip(*parts))
    distinct, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    known = counts[inverse] > 1
    doc, tag = (x[owner_] if len(owner_) else np.zeros(0, np.int64) for x in (docs, tags))
    packed = _pack(at, l_lo, l_hi, known.astype(np.int64))
    spread = _spread(packed.view(np.uint64) ^ doc.view(np.uint64) ^ _spread(tag.view(np.uint64)))
    probes = distinct[counts > 1]
    whole = np.array(rows, np.int64).reshape(-1, 3)
    return pd.DataFrame({
        "key": np.concatenate([np.where(known, spread, key), probes, _spread(whole[:, 0].astype(np.uint64))]).view(np.int64),
        "doc": np.concatenate([doc, np.zeros(len(probes), np.int64), whole[:, 0]]),
        "tag": np.concatenate([tag, np.zeros(len(probes), np.int64), whole[:, 1]]),
        "packed": np.concatenate([packed, np.full(len(probes), -1), whole[:, 2]])})


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, tag, text): the id with null below all others, and the hash of the text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"),
                       F.xxhash64("text").alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(doc, tag, packed) of the anchors whose run of bytes occurs again, and of texts equal to an earlier one."""
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, tags = frame.doc.to_numpy(np.int64), frame.tag.to_numpy(np.int64)
            held: list[bytes] = []
            at = load = 0
            for i, text in enumerate(frame.text):
                held.append(text.encode("utf-8", "surrogatepass"))
                load += len(held[-1])
                if load > BATCH_BYTES or i == len(frame) - 1:
                    yield _batch_anchors(ids[at:i + 1], tags[at:i + 1], held)
                    held, at, load = [], i + 1, 0

    found = _numbered(docs).mapInPandas(batches, "key long, doc long, tag long, packed long")
    again = F.count("*").over(Window.partitionBy("key")) > 1
    return (found.withColumn("_again", again)
            .where("packed >= 0 and (_again or packed & 1 = 1)")
            .select("doc", "tag", "packed"))


# --- suffixes --------------------------------------------------------------------------------------------------------

def _tokens(strings: list[bytes], width: int) -> np.ndarray:
    data = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8)
    return data.reshape(len(strings), width)


def multikey_quicksort(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows: sort by the first eight bytes, then each run of equal ones by the next eight, and so on."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    new = np.concatenate([[True], np.diff(words[order, 0]) != 0]) if len(order) else np.zeros(0, bool)
    for t in range(1, words.shape[1]):
        tied = ~new | np.concatenate([~new[1:], [False]])
        if not tied.any():
            break
        at = np.flatnonzero(tied)
        rows_, run = order[at], np.cumsum(new)[at]
        token = words[rows_, t]
        inner = np.lexsort((token, run))
        order[at] = rows_[inner]
        token, run = token[inner], run[inner]
        new[at] |= np.concatenate([[True], (np.diff(token) != 0) | (np.diff(run) != 0)])
    return order


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading bytes that the rows of ``a`` and ``b`` share."""
    differ = a != b
    return np.where(differ.any(axis=-1), differ.argmax(axis=-1), a.shape[-1])


def _prefix_numbers(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each row in sorted order, bytes that each sorted row shares with the one before; -1 for the first)."""
    order = multikey_quicksort(rows)
    shared = np.concatenate([[-1], _common(rows[order[1:]], rows[order[:-1]])])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, shared


_RIGHT, _LEFT = 104, 72  # bytes of suffix and of reversed text before it, filled up to whole tokens


def cut(text: bytes, packed: np.ndarray) -> list[tuple[int, int, int, bytes, bytes]]:
    """(anchor, l_lo, l_hi, suffix, reversed bytes before) per anchor of a text."""
    out = []
    for p in packed.tolist():
        at, l_lo, l_hi = (p >> 15) & 0xFFFFFFFF, (p >> 8) & 127, (p >> 1) & 127
        out.append((at, l_lo, l_hi, text[at:at + LENGTH - l_lo], text[at - l_hi:at][::-1]))
    return out


def repeated_windows(doc: np.ndarray, at: np.ndarray, l_lo: np.ndarray, l_hi: np.ndarray, right: np.ndarray, left: np.ndarray,
                     border: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Runs (row, first l, last l) of windows that occur earlier in these rows, and the (row, l) that are the
    earliest of their group and may have equals elsewhere: windows with LENGTH - l bytes of suffix within ``border``.
    Rows must be in the order of (doc, at).
    """
    (place_r, shared_r), (place_l, shared_l) = _prefix_numbers(right), _prefix_numbers(left)
    n, again, open_ = len(doc), np.zeros((len(doc), _PLACES), bool), []
    for back in range(_PLACES):
        rows = np.flatnonzero((l_lo <= back) & (back <= l_hi))
        if not len(rows):
            continue
        number_r = np.cumsum(shared_r < LENGTH - back)[place_r[rows]]
        number_l = np.cumsum(shared_l < back)[place_l[rows]] if back else np.zeros(len(rows), np.int64)
        _, first, group = np.unique(number_r * (n + 1) + number_l, return_index=True, return_inverse=True)
        lead = rows[first[group]]
        again[rows, back] = (doc[rows] > doc[lead]) | (at[rows] > at[lead])
        leads = rows[first]
        open_ += [(int(r), back) for r in leads[border[leads] >= LENGTH - back]]
    edges = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    return list(zip(row.tolist(), begin.tolist(), (end - 1).tolist())), open_


_RECORD = "bucket int, doc long, tag long, at int, l_lo int, l_hi int, suffix binary, before binary"
_REMOVED = "doc long, tag long, start int, end int, window binary"


def _compressed(docs: DataFrame) -> DataFrame:
    """(doc, tag, z): texts as they travel."""
    @F.pandas_udf("binary")
    def squeeze(texts: pd.Series) -> pd.Series:
        z = zstandard.ZstdCompressor(level=1)
        return pd.Series([z.compress(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=object)

    return _numbered(docs).select("doc", "tag", squeeze("text").alias("z"))


def _with_texts(found: DataFrame, docs: DataFrame) -> DataFrame:
    per_doc = found.groupBy("doc", "tag").agg(F.collect_set("packed").alias("packed"))
    return _compressed(docs).join(per_doc, ["doc", "tag"])


def _records(frames: Iterator[pd.DataFrame], splitters: np.ndarray | None, spread: int = 1) -> Iterator[pd.DataFrame]:
    z = zstandard.ZstdDecompressor()
    names = [c.split(" ")[0] for c in _RECORD.split(", ")]
    for frame in frames:
        out, load = [], 0
        for i, (doc, tag, squeezed, packed) in enumerate(zip(frame.doc, frame.tag, frame.z, frame.packed)):
            text = z.decompress(squeezed)
            packed = np.unique(np.asarray(packed, np.int64))
            whole = ((packed >> 8) & 127) == _WHOLE
            if whole.any():
                out.append((-1, doc, tag, 0, _WHOLE, 0, b"", b""))
                packed = packed[~whole]
            out += [(0, doc, tag, *x) for x in cut(text, packed)]
            load += len(text)
            if load > BATCH_BYTES or i == len(frame) - 1:
                yield _placed(pd.DataFrame(out, columns=names), splitters, spread)
                out, load = [], 0


def _keys(suffix: pd.Series, before: pd.Series) -> np.ndarray:
    return np.array([s.ljust(_RIGHT, b"\0") + b for s, b in zip(suffix, before)], f"S{_RIGHT + _LEFT}")


def _placed(frame: pd.DataFrame, splitters: np.ndarray | None, spread: int) -> pd.DataFrame:
    """Equal records of this batch merged into the earliest (the others are repeats in all their windows); buckets set."""
    if splitters is None or not len(frame):
        return frame[frame.bucket >= 0]
    frame = frame.sort_values(["doc", "at"], kind="stable")
    whole = frame.bucket < 0
    records = frame[~whole]
    lead = records.groupby(["suffix", "before"], sort=False)[["doc", "at"]].transform("first")
    later = (records.doc > lead.doc) | (records["at"] > lead["at"])
    kept = records[~later].copy()
    kept["bucket"] = np.searchsorted(splitters, _keys(kept.suffix, kept.before), "right")
    done = pd.concat([frame[whole], records[later].assign(suffix=b"", before=b"")])
    done = done.drop_duplicates(["doc", "tag", "at", "l_lo", "l_hi"])  # equal rows of one id
    # rows that are decided travel along under numbers past the buckets, as many as their number asks for
    mixed = (done.doc.to_numpy(np.int64).view(np.uint64) * _MIX[0] + done.tag.to_numpy(np.int64).view(np.uint64) * _MIX[1]
             + done["at"].to_numpy(np.int64).view(np.uint64) * _MIX[2]) >> np.uint64(32)
    done["bucket"] = len(splitters) + 1 + (mixed % np.uint64(spread)).astype(np.int64)
    return pd.concat([kept, done])


def _bucket(frame: pd.DataFrame, splitters: np.ndarray) -> pd.DataFrame:
    names = [c.split(" ")[0] for c in _REMOVED.split(", ")]
    b = int(frame.bucket.iloc[0])
    if b > len(splitters):
        start = np.where(frame.l_lo == _WHOLE, 0, frame["at"] - frame.l_hi)
        end = np.where(frame.l_lo == _WHOLE, np.iinfo(np.int32).max, frame["at"] - frame.l_lo + LENGTH)
        return pd.DataFrame({"doc": frame.doc, "tag": frame.tag, "start": start, "end": end, "window": None})
    frame = frame.sort_values(["doc", "at"], kind="stable").reset_index(drop=True)
    suffix, before = frame.suffix.to_list(), frame.before.to_list()
    right, left = _tokens(suffix, _RIGHT), _tokens(before, _LEFT)
    doc, tag, at, l_lo, l_hi = (frame[c].to_numpy(np.int64) for c in ("doc", "tag", "at", "l_lo", "l_hi"))
    border = np.full(len(frame), -1)
    for s in (splitters[b - 1:b] if b else []), splitters[b:b + 1]:
        for edge in s:
            head = np.frombuffer(edge.ljust(_RIGHT + _LEFT, b"\0")[:_RIGHT], np.uint8)
            border = np.maximum(border, _common(right, np.broadcast_to(head, right.shape)))
    runs, open_ = repeated_windows(doc, at, l_lo, l_hi, right, left, border)
    out = [(doc[r], tag[r], at[r] - hi, at[r] - lo + LENGTH, None) for r, lo, hi in runs]
    for r, back in open_:
        window = before[r][:back][::-1] + suffix[r][:LENGTH - back]
        out.append((doc[r], tag[r], at[r] - back, at[r] - back + LENGTH, hashlib.md5(window, usedforsecurity=False).digest()))
    return pd.DataFrame(out, columns=names)


def repeats(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, splitter_rows: int = SPLITTER_ROWS) -> DataFrame:
    """(doc, tag, start, end): byte ranges to remove; they may overlap and pass the end of a text."""
    found = truncate(repeated_anchors(docs))
    n = found.count()
    # the sample takes whole documents by their hash, so only their texts are moved for it
    part = max(1, n // splitter_rows)
    chosen = F.pmod(F.xxhash64("doc", "tag"), F.lit(part)) == 0
    sample = _with_texts(found.where(chosen), docs.where(F.pmod(F.xxhash64(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)), F.xxhash64("text")), F.lit(part)) == 0))
    keys = sample.mapInPandas(lambda frames: _records(frames, None), _RECORD).select("suffix", "before")
    rows = keys.limit(4 * splitter_rows).toPandas()
    ordered = np.unique(_keys(rows.suffix, rows.before)) if len(rows) else np.zeros(0, f"S{_RIGHT + _LEFT}")
    buckets = max(1, min(-(-n // bucket_rows), len(ordered) // 4))
    splitters = ordered[np.linspace(0, len(ordered), buckets + 1).astype(int)[1:-1]]
    handle = docs.sparkSession.sparkContext.broadcast(splitters)  # at most splitter_rows keys
    spread = max(64, -(-n // bucket_rows))
    records = _with_texts(found, docs).mapInPandas(lambda frames: _records(frames, handle.value, spread), _RECORD)
    removed = truncate(records.groupBy("bucket").applyInPandas(lambda frame: _bucket(frame, handle.value), _REMOVED))
    inside = removed.where("window is null").drop("window")
    edge = removed.where("window is not null")
    first = edge.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    across = edge.join(first, "window").where((F.col("doc") > F.col("_first.doc")) | (F.col("start") > F.col("_first.start")))
    return inside.unionByName(across.select("doc", "tag", "start", "end"))


def remaining(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    out, at, removed, spans, last = [], 0, 0, 0, -1
    for start, end in sorted(ranges):
        start, end = max(start, at), min(end, len(text))
        if end > start:
            spans += start != last
            out.append(text[at:start])
            removed += end - start
            at = last = end
    out.append(text[at:])
    return removed, spans, b"".join(out)


def dedup(docs: DataFrame, texts_out: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row and, if ``texts_out``, the bytes that are left."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts_out
    names = [c.split(" ")[0] for c in schema.split(", ")]
    ranges = repeats(docs).groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z = zstandard.ZstdDecompressor()
        for frame in frames:
            out = []
            for doc, squeezed, found in zip(frame.doc, frame.z, frame.ranges):
                text = z.decompress(squeezed)
                cuts = [] if found is None else [(r["start"], r["end"]) for r in found]
                removed, spans, kept = remaining(text, cuts)
                out.append((None if doc == _NULL_ID else doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest(),
                            *([kept] if texts_out else [])))
            yield pd.DataFrame(out, columns=names, dtype=object)

    return _compressed(docs).join(ranges, ["doc", "tag"], "left").select("doc", "z", "ranges").mapInPandas(finish, schema)
