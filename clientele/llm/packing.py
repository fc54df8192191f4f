"""Packing tokenised documents into sequences of bounded length by the sum-of-squares rule.

A document is its byte-level BPE ids and an end id. Only a document that is
longer than a sequence is cut, from its end, so that just its first piece may
be short. A piece goes where the sum of the squared numbers of open sequences
per residual gap becomes smallest: that keeps all gaps about equally common,
so whatever comes next finds one that it fills (Csirik, Johnson, Kenyon,
Orlin, Shor and Weber, 2006). Longer pieces come first, and a sequence is
opened only for a piece that no open one has room for; with either rule left
out, one to four sequences more in a hundred were needed for the sample tables.

Pieces are packed in units of at most ``UNIT_ROWS`` rows. A unit closes its
full sequences and hands the emptiest of the others, at most ``LEFT_ROWS``
rows, to the next level, where up to about ``FAN_IN`` units are packed together,
until one unit is left. No task holds more than that, whatever the number of
documents; the space lost is that of the last unit and, if lengths do not fit
each other at all, that of sequences nothing fits into.

The vocabulary is a file of the tokenizers library. Its merges are done by
tiktoken, which takes about a third of the time; both give the same ids for a
text around every single code point and for random texts.

Defined results: a null or empty text is the end id alone; every row is a
document, repeated rows too; ids of rows may be null; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.bpe import _byte_symbols
from clientele.llm.common import as_text, with_long
from clientele.session import truncate

SEQUENCE = 1024
END_ID = 2
UNIT_ROWS = 200_000
LEFT_ROWS = 20_000
FAN_IN = 16
# The word pattern and the settings of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

_PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"
_LEVEL_BITS, _UNIT_BITS = 56, 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit numbers, from the vocabulary file of a byte-level BPE tokenizer."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"] != _PRE_TOKENIZER:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        byte_of = {c: b for b, c in enumerate(_byte_symbols())}
        # ids number the merges in their order, so they are the ranks
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in spec["model"]["vocab"].items()}
        self.merge = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.marks = os.path.commonprefix(list(self.special))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.special or self.marks not in text:
            return np.array(self.merge(text), "<u4").tobytes()
        parts = [[self.special[p]] if p in self.special else self.merge(p) for p in self.cut.split(text) if p]
        return np.concatenate([np.array(p, "<u4") for p in parts]).tobytes()


def cut_points(n: int, limit: int = SEQUENCE) -> list[int]:
    """Starts of the pieces of a document of ``n`` ids, and ``n``."""
    if n <= limit:
        return [0, n]
    return [0] * (n % limit > 0) + [*range(n % limit, n + 1, limit)]


def pieces(docs: DataFrame, path: str | None = None, text: str = "text", limit: int = SEQUENCE, end_id: int = END_ID,
           ids_out: bool = False, batch_rows: int = 10_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if ``ids_out``, the ids of the piece.

    ``path``: the vocabulary file, as every executor sees it.
    """
    schema = _PIECES + (", ids array<int>" if ids_out else "")
    names = [c.split(" ")[0] for c in schema.split(", ")]
    place = path or default_path()

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, end = Tokens(place), np.array([end_id], "<u4").tobytes()

        out: list[tuple] = []
        for frame in frames:
            for doc_id, value in frame.itertuples(index=False, name=None):
                ids = tokens.encode(value) + end
                at = cut_points(len(ids) // 4, limit)
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    part = ids[4 * a:4 * b]
                    out.append((doc_id, k, a, b - a, zlib.crc32(part), *([np.frombuffer(part, "<i4").tolist()] if ids_out else [])))
                if len(out) >= batch_rows:
                    yield pd.DataFrame(out, columns=names, dtype=object)
                    out = []
        yield pd.DataFrame(out, columns=names, dtype=object)

    return with_long(docs.select(*as_text("doc_id"), text).mapInPandas(batches, schema), "doc_id")


def place(lengths: np.ndarray, limit: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the order given, and the gap of each bin."""
    count = np.zeros(limit + 1, np.int64)  # open bins per gap; full bins are not open
    with_gap: list[list[int]] = [[] for _ in range(limit + 1)]
    bins, offsets, gaps = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, s in enumerate(lengths.tolist()):
        # a bin moves from gap g to g - s: (N[g] - 1)^2 + (N[g - s] + 1)^2 against N[g]^2 + N[g - s]^2, by half
        change = np.where(count[s:limit] > 0, count[:limit - s] - count[s:limit] + 1, limit * len(lengths) + 1)
        if s < limit and count[s]:
            change[0] = 0.5 - count[s]  # the bin becomes full and leaves the count
        best = int(change.argmin()) if s < limit else -1
        if best >= 0 and count[s + best]:
            gap = s + best
            b = with_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, b = limit, len(gaps)
            gaps.append(limit)
        bins[i], offsets[i], gaps[b] = b, limit - gap, gap - s
        if gap > s:
            count[gap - s] += 1
            with_gap[gap - s].append(b)
    return bins, offsets, np.array(gaps, np.int64)


def place_again(lengths: np.ndarray, limit: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place``, longest first; what lies in bins that stay open is placed anew as long as that saves bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins[order], offsets[order], gaps = place(lengths[order], limit)
    while True:
        loose = order[gaps[bins[order]] > 0]
        open_bins = np.unique(bins[loose])
        again, at, new_gaps = place(lengths[loose], limit)
        if len(new_gaps) >= len(open_bins):
            return bins, offsets, gaps
        bins[loose], offsets[loose] = open_bins[again], at
        gaps[open_bins] = 0
        gaps[open_bins[:len(new_gaps)]] = new_gaps


def _pack_unit(frame: pd.DataFrame, level: int, unit: int, limit: int, left_rows: int) -> pd.DataFrame:
    """The rows with sequence, offset and whether they go on to the next level."""
    bins, offsets, gaps = place_again(frame["length"].to_numpy(np.int64), limit)
    rows_of = np.bincount(bins, minlength=len(gaps))
    emptiest = np.argsort(-gaps, kind="stable")
    goes_on = np.zeros(len(gaps), bool)
    goes_on[emptiest] = (np.cumsum(rows_of[emptiest]) <= left_rows) & (gaps[emptiest] > 0)
    return frame.assign(sequence_id=(level << _LEVEL_BITS) + (unit << _UNIT_BITS) + bins, offset=offsets,
                        unit=unit, goes_on=goes_on[bins])


def _next_level(level: int, limit: int, left_rows: int):
    def task(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _pack_unit(frame.drop(columns="place"), level, int(key[0]), limit, left_rows)
    return task


def pack(rows: DataFrame, limit: int = SEQUENCE, unit_rows: int = UNIT_ROWS, left_rows: int = LEFT_ROWS) -> DataFrame:
    """``rows`` (with ``length``, 1 to ``limit``) and their sequence_id and offset."""
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema += ", sequence_id long, offset long, unit long, goes_on boolean"

    def first_level(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, run = [], 0, 0
        for frame in frames:
            while len(frame):
                part, frame = frame.iloc[:unit_rows - n], frame.iloc[unit_rows - n:]
                held, n = [*held, part], n + len(part)
                if n == unit_rows:
                    yield unit(held, run)
                    held, n, run = [], 0, run + 1
        if held:
            yield unit(held, run)

    def unit(held, run):
        frame = pd.concat(held, ignore_index=True)
        return _pack_unit(frame.drop(columns="part"), 0, int(frame["part"].iloc[0]) * 65536 + run, limit, left_rows)

    done, level = [], 0
    packed = truncate(rows.withColumn("part", F.spark_partition_id()).mapInPandas(first_level, schema))
    while (units := packed.select("unit").distinct().count()) > 1:
        level += 1
        done.append(packed.where("not goes_on"))
        groups = math.ceil(units / FAN_IN)

        going_on = packed.where("goes_on").select(*names, F.pmod(F.xxhash64("unit"), F.lit(groups)).alias("place"))
        packed = truncate(going_on.groupBy("place").applyInPandas(_next_level(level, limit, left_rows), schema))
    for part in done:
        packed = packed.unionByName(part)
    return packed.select(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, text: str = "text", limit: int = SEQUENCE,
                   end_id: int = END_ID, ids_out: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece."""
    return pack(truncate(pieces(docs, path, text, limit, end_id, ids_out)), limit)
