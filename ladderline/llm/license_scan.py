"""License scans: MinHash bands over overlapping windows find templates, containment confirms.

Texts and templates are words (A-Z lower-cased, outer punctuation dropped) and their 5-word
shingles (the whole template where it is shorter). A template of m shingles is looked for in
windows of w = floor(1.25 m) shingles, which start every w - m + 1, so that some window holds
every run of m shingles. A window whose MinHash agrees with the template's in one of 32 bands
of 2 is a candidate; a window that holds 80 % of the template has similarity 0.55 at least and
is missed with probability (1 - 0.55^2)^32 < 1e-5, an unchanged occurrence (0.8 or more) with
less than 1e-14. A template of one shingle is compared as it is, one of two or three has
w = m, so that an unchanged occurrence is a window of similarity 1: none of them are missed.
Candidates then count the template's shingles exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .text import as_bytes, begin, cached_by, lower_words, pieces_of, scramble, ship, shingle_hashes

BANDS, SHINGLE = 32, 5
_OUTER = b".,;:!?\"'()[]{}<>*%&$#|-_"

_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 1 << 32, BANDS * 2, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 31, BANDS * 2, dtype=np.uint32) * 2 + 1)[:, None]

#: Common public notices by SPDX-like name.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain worldwide.",),
    "all-rights-reserved": ("All rights reserved.",),
}


class _CoreHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word.strip(_OUTER))
        if len(word) <= 64:  # so that entries bound bytes
            if len(self) >= 150_000:
                self.clear()
            self[word] = h
        return h


_core = _CoreHash()
cached_by("license_scan", _core.clear)


def word_hashes(text: bytes | None) -> np.ndarray:
    words = lower_words(text)
    return np.fromiter(map(_core.__getitem__, words), np.uint64, len(words))


def _mixed(s: np.ndarray) -> np.ndarray:
    """(2 * BANDS, n) hash values of shingles."""
    x = (scramble(s) >> np.uint64(32)).astype(np.uint32)[None, :]
    return (x ^ _XOR) * _MUL


def _window_mins(v: np.ndarray, w: int, step: int) -> np.ndarray:
    """Minima over columns start .. start + w - 1 for starts 0, step, ... (the last window is cut short)."""
    n = v.shape[1]
    starts = np.arange(0, max(1, n - w + step), step)
    span, m = 1, v
    while span * 2 <= w and m.shape[1] > span:
        m = np.minimum(m[:, :-span], m[:, span:])
        span *= 2
    last = m.shape[1] - 1
    return np.minimum(m[:, np.minimum(starts, last)], m[:, np.minimum(np.maximum(starts + w - span, 0), last)])


def _bands(mins: np.ndarray) -> np.ndarray:
    return (mins[0::2].astype(np.uint64) << np.uint64(32)) | mins[1::2]


@dataclass
class Template:
    name: str
    k: int
    shingles: np.ndarray
    """Sorted distinct shingle hashes."""
    bands: np.ndarray


class Matcher:
    """Templates by shingle length and number of shingles."""

    def __init__(self, templates: dict[str, tuple[str, ...]], percent: int = 80):
        self.percent = percent
        self.classes: dict[int, dict[int, list[Template]]] = {}
        for name, texts in templates.items():
            for text in texts:
                h = word_hashes(text.encode())
                if len(h):
                    k, s = min(SHINGLE, len(h)), np.unique(shingle_hashes(h, SHINGLE))
                    self.classes.setdefault(k, {}).setdefault(len(s), []).append(Template(name, k, s, _bands(_mixed(s).min(axis=1)[:, None])[:, 0]))

    def find(self, text: bytes | None) -> list[tuple[str, int, int, int]]:
        """(name, first word, words, percent of the template held), one for each name: the best, then first, match."""
        h = word_hashes(text)
        best: dict[str, tuple[int, int, int]] = {}
        for k, classes in self.classes.items():
            if len(h) < k:
                continue
            s = shingle_hashes(h, k)
            for t in classes.get(1, ()):
                for j in np.nonzero(s == t.shingles[0])[0][:1]:
                    self._confirm(t, s, int(j), best)
            longer = {m: group for m, group in classes.items() if m > 1}
            if not longer:
                continue
            for at in range(0, len(s), 1 << 13):  # slices overlap by the longest window
                mixed = _mixed(s[at : at + (1 << 13) + 5 * max(longer) // 4])
                for m, group in longer.items():
                    w = 5 * m // 4
                    keys = _bands(_window_mins(mixed, w, w - m + 1))
                    for t in group:
                        for j in np.nonzero((keys == t.bands[:, None]).any(axis=0))[0]:
                            self._confirm(t, s, at + int(j) * (w - m + 1), best)
        return [(n, first, words, -p) for n, (p, first, words) in sorted(best.items())]

    def _confirm(self, t: Template, s: np.ndarray, lo: int, best: dict[str, tuple[int, int, int]]) -> None:
        """Count the template's shingles in the window at lo and the overhang of its neighbours."""
        m = len(t.shingles)
        spare = -(-m // 4) if m > 1 else 0
        start = max(0, lo - spare)
        near = s[start : lo + m + 2 * spare]
        hit = np.nonzero(np.isin(near, t.shingles))[0]
        got = len(np.unique(near[hit]))
        if 100 * got >= self.percent * m:
            one = (-(100 * got // m), start + int(hit[0]), int(hit[-1] - hit[0]) + t.k)
            best[t.name] = min(one, best.get(t.name, one))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row per document and license found: key, license, first_word, n_words, percent.

    first_word counts from 0; percent is how much of the template's shingles the place holds
    (``percent`` or more). Null and empty texts match nothing; null keys and repeated rows are
    scanned like others; other columns are left out. No shuffle; templates are a few kB.
    """
    ship(docs.sparkSession)
    given = TEMPLATES if templates is None else templates
    made: list[Matcher] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("license_scan")
        if not made:
            made.append(Matcher(given, percent))
        for b in pieces_of(batches, "_text"):
            found = [(i, *f) for i, t in enumerate(as_bytes(b.column(1))) for f in made[0].find(t)]
            row, name, first, n, p = zip(*found, strict=True) if found else ((),) * 5
            cols = [pa.array(x, pa.int64()) for x in (first, n, p)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(name, pa.string()), *cols], names=[key, "license", "first_word", "n_words", "percent"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, docs[text].alias("_text")).mapInArrow(run, f"`{key}` {kind}, license string, first_word bigint, n_words bigint, percent bigint")
