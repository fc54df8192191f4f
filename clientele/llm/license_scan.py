"""License scan: winnowed template fingerprints pick candidates, banded alignment measures them.

Templates are license notices as word sequences. The hashes of all runs of
``GRAM`` words of a template, thinned by winnowing (the smallest of each
window, the rightmost of equal ones), form an inverted index from fingerprint
to (template, position). The index is a constant of the library and is sent to
every task. A document's winnowed fingerprints look up the index; the hits of
one template on neighbouring diagonals form a candidate; the template is then
aligned to the words around it inside a band of diagonals. A match is reported
with its coverage (share of the template's words that are aligned to equal
words) and its span in code points if the coverage is ``COVERAGE`` or more and
its deciding words (``DECIDING``: name, terms and version of the license) are
all aligned, one right after the other.

Winnowing keeps at least one fingerprint of every run of GRAM + WINDOW - 1
equal words; with WINDOW 1 for templates that are short, none is lost.

Defined results: a null or empty text has no match; overlapping matches of
different templates are all reported, those of one template are reported once
(best coverage, then the earlier); repeated rows get equal results; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect
from collections import defaultdict
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from clientele.llm.common import as_text, map_texts, with_long

#: Notices as their licenses word them (fixed texts).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                "conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD": "Released under the BSD License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies",
    "Unlicense-text": "This is free and unencumbered software released into the public domain",
}
#: What tells a template's license from others with a similar notice; templates of whole sentences need none.
DECIDING = {
    "Apache-2.0": "Apache License Version 2 0", "Apache-2.0-header": "Apache License Version 2 0", "MIT": "MIT License",
    "GPL-3.0": "GNU General Public License version 3", "GPL-header": "GNU General Public License", "CC-BY-NC-4.0": "CC BY NC 4 0",
    "CC-BY-4.0": "Creative Commons Attribution 4 0", "MPL-2.0": "Mozilla Public License v 2 0",
    "BSD": "BSD License", "GPL-2.0": "GNU General Public License version 2", "LGPL-3.0": "GNU Lesser General Public License version 3",
    "LGPL-2.1": "GNU Lesser General Public License version 2 1", "AGPL-3.0": "GNU Affero General Public License version 3",
    "CC-BY-4.0-short": "CC BY 4 0", "CC-BY-SA-4.0": "CC BY SA 4 0", "CC-BY-NC-SA-4.0": "CC BY NC SA 4 0",
}
GRAM = 3
WINDOW = 4
SHORT = 16  # templates up to this many words keep every fingerprint
BAND = 6
COVERAGE = 0.8
_TOKEN = re.compile(r"[^\W_]+")


def _gram_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of each run of GRAM word ids; -1 where a word is in no template."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h, known = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(GRAM):
        part = ids[i:i + n]
        h = (h * 1_000_003 + part + 1) & 0x7FFFFFFFFFFF
        known &= part >= 0
    return np.where(known, (h * 2654435761) & 0x7FFFFFFFFFFF, -1)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of each window, the rightmost of equal ones."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, int)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(view)) + window - 1 - np.argmin(view[:, ::-1], axis=1))


class Index:
    """Template words, fingerprints and the inverted index."""

    def __init__(self, templates: dict[str, str]):
        words = {name: _TOKEN.findall(text.lower()) for name, text in templates.items()}
        self.vocabulary: dict[str, int] = {}
        for sequence in words.values():
            for w in sequence:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.names = sorted(templates)
        self.words = [np.array([self.vocabulary[w] for w in words[n]]) for n in self.names]
        self.deciding = [self._deciding(words[n], _TOKEN.findall(DECIDING.get(n, "").lower())) if templates[n] == TEMPLATES.get(n) else frozenset()
                         for n in self.names]
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, ids in enumerate(self.words):
            hashes = _gram_hashes(ids)
            kept = range(len(hashes)) if len(ids) <= SHORT else winnow(hashes, WINDOW).tolist()
            for at in kept:
                self.postings[int(hashes[at])].append((t, at))
        self.fingerprints = np.array(sorted(self.postings))

    @staticmethod
    def _deciding(words: list[str], phrase: list[str]) -> frozenset[int]:
        """Places of the deciding words in a template."""
        at = next((i for i in range(len(words)) if words[i:i + len(phrase)] == phrase), 0)
        return frozenset(range(at, at + len(phrase)))

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(template, document position where it would start) of fingerprints found, one per group of diagonals."""
        hashes = _gram_hashes(ids)
        # the fingerprints of a document are looked up all, which contains every winnowed choice of a template
        hits = np.flatnonzero(np.isin(hashes, self.fingerprints))
        found: dict[int, list[int]] = defaultdict(list)
        for at in hits.tolist():
            for t, p in self.postings[int(hashes[at])]:
                found[t].append(at - p)
        out = []
        for t, diagonals in found.items():
            # two notices of a template start farther apart than half its length, so short ones next to each other stay two
            step, last = min(BAND, (len(self.words[t]) - 1) // 2), None
            for d in sorted(diagonals):
                if last is None or d - last > step:
                    out.append((t, d))
                    last = d
        return out

    def align(self, t: int, ids: np.ndarray, diagonal: int) -> tuple[float, int, int]:
        """(coverage, first, last + 1 document word) of the template aligned within the band around a diagonal."""
        template, width = self.words[t], 2 * BAND + 1
        best = np.zeros(width, int)  # most equal words so far on each diagonal
        first, last = np.full(width, -1), np.full(width, -1)
        for i, word in enumerate(template.tolist()):
            at = i + diagonal - BAND + np.arange(width)
            inside = (at >= 0) & (at < len(ids))
            equal = inside & (ids[np.clip(at, 0, len(ids) - 1)] == word)
            must, tied = i in self.deciding[t], {i, i + 1} <= self.deciding[t]
            new, nf, nl = np.full(width, -len(template) - 1) if must else best.copy(), first.copy(), last.copy()
            # a template word without partner shifts one diagonal down, a document word is skipped going up
            for k in range(width):
                for j in ((k + 1,) if k + 1 < width and not must else ()):
                    if best[j] > new[k]:
                        new[k], nf[k], nl[k] = best[j], first[j], last[j]
            for k in np.flatnonzero(equal).tolist():
                if best[k] + 1 > new[k] and (best[k] >= 0 or not must):
                    new[k], nl[k] = best[k] + 1, at[k]
                    nf[k] = first[k] if first[k] >= 0 else at[k]
            for k in range(1, 1 if tied else width):
                if new[k - 1] > new[k]:
                    new[k], nf[k], nl[k] = new[k - 1], nf[k - 1], nl[k - 1]
            best, first, last = new, nf, nl
        k = min(range(width), key=lambda k: (-best[k], abs(k - BAND)))  # of equal ones the notice that the hit is in
        return best[k] / len(template), int(first[k]), int(last[k]) + 1


@lru_cache(4)
def index(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


def scan(text: str | None, idx: Index, coverage: float = COVERAGE) -> list[tuple[str, int, int, float]]:
    """(template, start, end, coverage) in the order of start, end, template; offsets in code points."""
    if not text:
        return []
    # lower() can lengthen a text (one letter), so words are cut first and lowered one by one
    spans = [m.span() for m in _TOKEN.finditer(text)]
    get = idx.vocabulary.get
    ids = np.array([get(text[a:b].lower(), -1) for a, b in spans], np.int64)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for t, diagonal in idx.candidates(ids):
        share, a, b = idx.align(t, ids, diagonal)
        if share >= coverage:
            old = best.get((t, b))
            if old is None or share > old[0]:
                best[t, b] = share, a, b
    out, taken = [], defaultdict(list)
    for (t, _), (share, a, b) in sorted(best.items(), key=lambda x: (-x[1][0], x[1][1], x[0])):
        at = bisect(taken[t], (a, b))  # spans of a template never overlap, so the two next to this one decide
        if all(e <= a or b <= s for s, e in taken[t][max(at - 1, 0):at + 1]):
            taken[t].insert(at, (a, b))
            out.append((idx.names[t], spans[a][0], spans[b - 1][1], float(round(share, 6))))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def find(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, n_matches, best_coverage, matches) per row; matches is name:start:end:coverage, comma-joined."""
    fixed = tuple((templates or TEMPLATES).items())

    def row(doc_id, text):
        found = scan(text, index(fixed), coverage)
        listed = ",".join(f"{n}:{a}:{b}:{c:.3f}" for n, a, b, c in found)
        return doc_id, len(found), max((c for *_, c in found), default=0.0), listed

    schema = "doc_id string, n_matches long, best_coverage double, matches string"
    return with_long(map_texts(docs, [*as_text("doc_id"), "text"], schema, row), "doc_id")
