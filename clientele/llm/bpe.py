"""BPE encoding and decoding of whole texts with a word-level BPE vocabulary file.

A text is cut into words as the vocabulary file says: special tokens first,
then NFC, white space, lower case and the word pattern. Distinct words of a
batch are merged together: their symbols lie in one flat array, the rank of
every neighbouring pair is found by binary search over sorted pair keys, and
each round merges, in every word, the occurrences of its lowest rank.

A word is short, but a text may repeat it a million times, so each task keeps
the encoded pieces of a bounded number of distinct pieces between white space.

Defined results: a null or empty text has no tokens and decodes to the empty
text; repeated rows get equal results; an empty table gives an empty result;
other columns are not read. Lone surrogates cannot occur in a Parquet string.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from clientele.llm.common import as_text, with_long

CACHED_PIECES = 200_000
#: Separators that str.split() takes for white space and the vocabulary's pattern does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(r"[^\S\x1c-\x1f]+")
#: In these scripts, letters and composition follow the tokenizer's version of Unicode, by its own normaliser and splitter.
_RARE = re.compile("[\u0590-\u1dff\u2c00-\U0010ffff]")
_NONE = np.iinfo(np.int64).max


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte used by byte-level vocabularies: printable Latin-1 stays, the rest follows 255."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Vocabulary, merges and pattern of one file; encodes lists of words in numpy rounds."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = dict((i, t) for t, i in {**vocab, **self.special}.items())
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.rare_form = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.rare_split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.marks = os.path.commonprefix(list(self.special))
        symbols = _byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.last = np.array([vocab[c + end] for c in symbols], np.int64)
        self.size = 1 + max(self.names)
        pairs = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in model["merges"]], np.int64)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int64), pairs[:, 2]
        # a merge may be done at all its places at once if no merge of its result has a lower rank
        uses = np.full(self.size, _NONE)
        np.minimum.at(uses, pairs[:, 0], np.arange(len(pairs)))
        np.minimum.at(uses, pairs[:, 1], np.arange(len(pairs)))
        self.at_once = uses[self.merged] > np.arange(len(pairs))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word (non-empty), by merge rounds over all of them."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(b) for b in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids, word = self.inner[data], np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths) - 1
        ids[ends] = self.last[data[ends]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            rank = np.full(len(ids), _NONE)
            rank[:-1] = np.where(word[:-1] == word[1:], self.ranks(ids[:-1], ids[1:]), _NONE)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            span = np.diff(np.append(first, len(ids)))
            best = np.minimum.reduceat(rank, first)
            over = np.repeat(best == _NONE, span)
            if over.any():  # words without a pair to merge leave the array
                done.append((word[over], ids[over]))
                ids, word, rank = ids[~over], word[~over], rank[~over]
                if not len(ids):
                    break
                span, best = span[best != _NONE], best[best != _NONE]
            ids, word = self._merge(ids, word, rank, np.repeat(best, span), span)
        at, found = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(at, kind="stable")
        cuts = np.cumsum(np.bincount(at, minlength=len(words)))[:-1]
        return [part.tolist() for part in np.split(found[order], cuts)]

    def _merge(self, ids, word, rank, best, span):
        here = rank == best
        place = np.flatnonzero(here)
        # overlapping places of one pair (aaa): every second one of a run, from the left
        start = np.concatenate([[True], np.diff(place) != 1])
        run = np.maximum.accumulate(np.where(start, np.arange(len(place)), 0))
        pick = (np.arange(len(place)) - run) % 2 == 0
        slow = ~self.at_once[rank[place]]
        if slow.any():  # only the first place in a word
            opening = np.concatenate([[True], word[place][1:] != word[place][:-1]])
            pick &= ~slow | opening
        place = place[pick]
        ids = ids.copy()
        ids[place] = self.merged[rank[place]]
        keep = np.ones(len(ids), bool)
        keep[place + 1] = False
        return ids[keep], word[keep]

    def pieces(self, text: str) -> list[str | int]:
        """The special tokens of a text as ids, the rest as normalised pieces without white space."""
        out: list[str | int] = []
        for part in self.cut.split(text) if self.marks in text else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                if _RARE.search(part):
                    part = self.rare_form.normalize_str(part)
                else:  # letter by letter: the final sigma keeps its plain form
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += [p for p in _SPACES.split(part) if p] if _NOT_SPACE.search(part) else part.split()
        return out

    def words(self, piece: str) -> list[str]:
        if _RARE.search(piece):
            return [w for w, _ in self.rare_split.pre_tokenize_str(piece)]
        return self.pattern.findall(piece)

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space, as without a decoder."""
        return " ".join([self.names[i] for i in ids if i in self.names])


class Encoder:
    """Encodes texts with a bounded memory of pieces already seen."""

    def __init__(self, bpe: WordBpe, cached: int = CACHED_PIECES):
        self.bpe, self.cached = bpe, cached
        self.seen: dict[str | int, tuple[int, str, str]] = {}

    def _learn(self, pieces: set[str | int]) -> dict[str | int, tuple[int, str, str]]:
        words = {p: self.bpe.words(p) for p in pieces if isinstance(p, str)}
        distinct = list({w for found in words.values() for w in found})
        ids = dict(zip(distinct, self.bpe.encode_words(distinct))) if distinct else {}
        out: dict[str | int, tuple[int, str, str]] = {}
        for p in pieces:
            tokens = [p] if isinstance(p, int) else [i for w in words[p] for i in ids[w]]
            out[p] = len(tokens), " ".join(map(str, tokens)), self.bpe.decode(tokens)
        return out

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, ids joined by spaces, decoded text) of each text."""
        cut = [self.bpe.pieces(t) if t else [] for t in texts]
        new = {p for pieces in cut for p in pieces}.difference(self.seen)
        if len(self.seen) + len(new) > self.cached:
            self.seen = {}
            new = {p for pieces in cut for p in pieces}
        self.seen.update(self._learn(new))
        for pieces in cut:
            if pieces:
                sizes, ids, names = zip(*map(self.seen.__getitem__, pieces))
                yield sum(sizes), " ".join(ids), " ".join(names)
            else:
                yield 0, "", ""


def load(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_texts(docs: DataFrame, path: str | None = None, text: str = "text", texts_out: bool = False,
                 batch_chars: int = 1_000_000) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if ``texts_out``, the ids and the decoded text.

    ``path``: the vocabulary file, as every executor sees it.
    """
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if texts_out:
        schema += ", ids array<int>, decoded string"
    place = path or default_path()

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(load(place))

        def rows(ids, texts):
            for doc_id, (n, joined, decoded) in zip(ids, encoder.encode(texts)):
                digest = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (joined, decoded)]
                yield (doc_id, n, *digest,
                       *([[int(i) for i in joined.split()], decoded] if texts_out else []))

        for frame in frames:
            out, at, load_ = [], 0, 0
            doc_ids, values = frame.iloc[:, 0].tolist(), frame.iloc[:, 1].tolist()
            for i, value in enumerate(values):
                load_ += len(value or "")
                if load_ > batch_chars or i == len(values) - 1:
                    out += rows(doc_ids[at:i + 1], values[at:i + 1])
                    at, load_ = i + 1, 0
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in schema.split(", ")], dtype=object)

    return with_long(docs.select(*as_text("doc_id"), text).mapInPandas(batches, schema), "doc_id")
