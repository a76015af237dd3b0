"""License scan with a trained paragraph classifier.

A softmax regression over hashed word n-grams (one to three words) tells licence families and ``unknown`` apart. It is
trained on the driver from the short notices below, varied by a fixed rule, against paragraphs of the corpus
and shuffled notice words as ``unknown``. Its temperature, and the probability from which a family is
believed, are calibrated on variants that it was not trained on. A prediction counts if a notice of that
family is found in the paragraph: most of its words, in order.

Texts are scanned whole in one pass: words of the notices are located by hash, without punctuation and comment marks,
and only passages of a paragraph (up to a line without words) that hold two different ones are looked at. Every window
of a passage that holds a notice is classified. All others have no features that tell a family, and are unknown.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix, text_slices, word_hashes

_U = np.uint64
UNKNOWN = "unknown"
FEATURE_BITS = 12
#: Paragraphs of the corpus, lowest hashes first, that stand for ``unknown`` in training.
SAMPLE = 2000
SIMILAR = 0.8

#: Usual short notices by SPDX identifier of the licence.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "This file is distributed under the Apache License 2.0",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "Released under CC0 1.0 Universal",
        "This work is dedicated to the public domain",
    ],
    "proprietary": [
        "All rights reserved",
        "Copyright, all rights reserved",
        "No part of this publication may be reproduced without permission",
    ],
}
#: Words that any text may have; they are features, but do not mark a passage.
_COMMON = set("a all and any as by for in is it law no of or part person the this to under use v with work without may be".split())
#: Bytes of a word as in ``tokens``; all others, line ends too, are spaces. Words lose the joints at their edges.
_PLAIN = np.full(256, 32, np.uint8)
_JOINTS = np.zeros(256, bool)
_JOINTS[list(b".+-")] = True
for _byte in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.+-":
    _PLAIN[_byte] = _byte
_WORD = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _features(words: list[str]) -> np.ndarray:
    """Numbers of the hashed n-grams of one to three words, each once."""
    if not words:
        return np.zeros(0, np.int64)
    _, _, data, offsets = next(text_slices(pa.array([" ".join(words)])))
    h = word_hashes(data, offsets)[0]
    grams = [h]
    for n in (2, 3):
        if len(h) >= n:
            parts = [h[k : len(h) - n + 1 + k] * _U(0x9E3779B97F4A7C15 + 2 * k + 2 * n) for k in range(n)]
            grams.append(mix(np.sum(parts, axis=0, dtype=_U)))
    return np.unique((np.concatenate(grams) >> _U(64 - FEATURE_BITS)).astype(np.int64))


def _variants(words: list[str], filler: list[list[str]], seed: int, count: int) -> Iterator[list[str]]:
    """A notice with some words left out and words of other paragraphs around it, by a fixed rule."""
    rng = np.random.default_rng(seed)
    for k in range(count):
        kept = [w for w in words if k == 0 or len(words) < 6 or rng.random() > 0.08]
        if k and filler:
            around = filler[int(rng.integers(len(filler)))]
            cut = int(rng.integers(0, 4))
            kept = around[:cut] + kept + around[cut : cut + int(rng.integers(0, 4))]
        yield kept


class Model:
    def __init__(self, corpus: list[str]):
        self.families = [*NOTICES, UNKNOWN]
        self.notices = {f: [tokens(n) for n in listed] for f, listed in NOTICES.items()}
        self.marks = {w for listed in self.notices.values() for n in listed for w in n} - _COMMON
        everyday = [t for t in map(tokens, corpus) if t and not any(self.similarity(f, t)[0] >= SIMILAR for f in NOTICES)]
        train, held = [], []
        for k, (family, listed) in enumerate(self.notices.items()):
            for i, notice in enumerate(listed):
                made = list(_variants(notice, everyday, 1000 * k + i, 40))
                train += [(k, m) for m in made[:28]]
                held += [(k, m) for m in made[28:]]
        unknown = [t[:40] for t in everyday] + list(self._shuffled(600))
        train += [(len(self.families) - 1, t) for t in unknown[::2]]
        held += [(len(self.families) - 1, t) for t in unknown[1::2]]
        self._fit(train)
        self._calibrate(held)

    def _shuffled(self, count: int) -> Iterator[list[str]]:
        """Marked words out of context: one or a few, in any order."""
        rng, pool = np.random.default_rng(7), sorted(self.marks)
        for _ in range(count):
            yield [pool[int(i)] for i in rng.integers(0, len(pool), int(rng.integers(1, 5)))]

    def _fit(self, rows: list[tuple[int, list[str]]]) -> None:
        lists = [_features(w) for _, w in rows]
        at = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
        feature = np.concatenate(lists)
        scale = 1 / np.sqrt(np.maximum([len(x) for x in lists], 1))
        x = np.zeros((len(rows), 1 << FEATURE_BITS), np.float32)
        x[at, feature] = scale[at]
        y = np.eye(len(self.families), dtype=np.float32)[[k for k, _ in rows]]
        weight = 1 / np.maximum(y.sum(0), 1)
        each = (y @ weight)[:, None] / len(self.families)
        w, b, speed = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32), 0.0
        for _ in range(150):
            z = x @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - y) * each
            speed = 0.9 * speed - 60 * (x.T @ g + 1e-6 * w)
            w, b = w + speed, b - 60 * 0.1 * g.sum(0)
        self.w, self.b, self.temperature, self.least = w, b, 1.0, 0.5

    def _scores(self, words: list[str]) -> np.ndarray:
        f = _features(words)
        return self.w[f].sum(0) / np.sqrt(max(len(f), 1)) + self.b

    def probabilities(self, words: list[str]) -> np.ndarray:
        z = self._scores(words) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def _calibrate(self, held: list[tuple[int, list[str]]]) -> None:
        """Temperature of least log loss, then the probability above which no more than 1 in 50 unknowns lies."""
        z = np.array([self._scores(w) for _, w in held])
        y = np.array([k for k, _ in held])
        best = None
        for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0):
            q = z / t - (z / t).max(1, keepdims=True)
            loss = (np.log(np.exp(q).sum(1)) - q[np.arange(len(y)), y]).mean()
            if best is None or loss < best[0]:
                best = (loss, t, np.exp(q) / np.exp(q).sum(1, keepdims=True))
        self.temperature = best[1]
        top = np.sort(best[2][y == len(self.families) - 1][:, :-1].max(1)) if (y == len(self.families) - 1).any() else np.zeros(1)
        self.least = float(max(0.4, top[min(len(top) - 1, int(0.98 * len(top)))]))

    def similarity(self, family: str, words: list[str]) -> tuple[float, str]:
        """Share of the words of the family's best notice that the passage has in order, and the notice."""
        best = (0.0, "")
        for k, notice in enumerate(self.notices[family]):
            row = full = (1 << len(notice)) - 1
            masks: dict[str, int] = {}
            for i, w in enumerate(notice):
                masks[w] = masks.get(w, 0) | 1 << i
            for w in words:
                match = row & masks.get(w, 0)
                row = ((row + match) | (row - match)) & full
            share = (len(notice) - row.bit_count()) / len(notice)
            if share > best[0]:
                best = (share, NOTICES[family][k])
        return best

    def judged(self, passage: str) -> tuple[str, float, float, str]:
        """Family, its probability, similarity and notice; ``unknown`` if no family is believed and confirmed."""
        words = tokens(passage)
        p = self.probabilities(words)
        k = int(np.argmax(p[:-1]))
        share, notice = self.similarity(self.families[k], words)
        if p[k] >= self.least and p[k] > p[-1] and share >= SIMILAR:
            return self.families[k], float(p[k]), share, notice
        return UNKNOWN, float(p[-1]), share, notice


    def found(self, words: list[str]) -> list[tuple[int, int, str, float, float, str]]:
        """First word, end, family, probability, similarity and notice of the notices in a passage that are believed.

        Of windows that overlap the most similar counts. A passage without any is judged as a whole.
        """
        windows, there = [], set(words)
        for family, listed in self.notices.items():
            for k, notice in enumerate(listed):
                n = len(notice)
                need = math.ceil(SIMILAR * n - 1e-9)
                if sum(w in there for w in notice) < need:
                    continue
                heads, masks, full = set(notice[: n - need + 1]), {}, (1 << n) - 1
                for i, w in enumerate(notice):
                    masks[w] = masks.get(w, 0) | 1 << i
                for a in (i for i, w in enumerate(words) if w in heads):
                    row, common, b = full, 0, a
                    for i in range(a, min(len(words), a + 2 * n + 6)):
                        match = row & masks.get(words[i], 0)
                        row = ((row + match) | (row - match)) & full
                        if n - row.bit_count() > common:
                            common, b = n - row.bit_count(), i + 1
                    if common >= need:
                        windows.append((-common / n, b - a, a, b, family, NOTICES[family][k]))
        out: list[tuple[int, int, str, float, float, str]] = []
        for share, _, a, b, family, notice in sorted(windows):
            if any(a < y and x < b for x, y, *_ in out):
                continue
            for around in (3, 0) if share == -1 else (3,):
                p = self.probabilities(words[max(0, a - around) : b + around])
                k = int(np.argmax(p[:-1]))
                if self.families[k] == family and p[k] >= self.least and p[k] > p[-1]:
                    out.append((a, b, family, float(p[k]), -share, notice))
                    break
        if not out:
            family, p, share, notice = self.judged(" ".join(words))
            if family != UNKNOWN:
                out.append((next(i for i, w in enumerate(words) if w in self.marks), len(words), family, p, share, notice))
        return sorted(out)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trains with at most ``sample`` paragraphs of the corpus, those of lowest hash, as examples of ``unknown``."""
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line")).where("length(line) BETWEEN 20 AND 2000")
    lowest = lines.select(F.xxhash64("line").alias("h"), "line").orderBy("h", "line").limit(sample)
    # A limit that is not the last step is cut on an executor; else every task would send its own sample to the driver.
    return Model(sorted(r.line for r in lowest.select("line").distinct().collect()))


_FOUND = "doc_id long, line long, family string, probability double, similarity double, notice string, passage string"


def _scanned(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, data, offsets = next(text_slices(pa.array([" ".join(sorted(model.marks))])))
        marks = np.unique(word_hashes(data, offsets)[0])
        sieve = np.zeros(1 << 16, bool)
        sieve[(marks >> _U(48)).astype(np.int64)] = True
        for batch in batches:
            rows = []
            for i, _, data, offsets in text_slices(batch.column("text")):
                words, start, end, _ = word_hashes(_PLAIN[data], offsets, edges=_JOINTS)
                at = np.flatnonzero(sieve[(words >> _U(48)).astype(np.int64)])
                at = at[np.isin(words[at], marks)]
                if len(at) < 2:
                    continue
                breaks = np.flatnonzero(data == 10)
                line = np.searchsorted(breaks, start)
                text = np.searchsorted(offsets, start, "right") - 1
                # A paragraph ends with its text, and before a line without words.
                part = np.cumsum(np.r_[False, (text[1:] != text[:-1]) | (np.diff(line) > 1)])
                begin = np.flatnonzero(np.r_[True, (np.diff(part[at]) > 0) | (np.diff(at) > 12)])
                for a, b in zip(begin, np.append(begin[1:], len(at)), strict=True):
                    if b - a < 2 or len(np.unique(words[at[a:b]])) < 2:
                        continue
                    top, bottom = np.searchsorted(part, part[at[a]] + np.array([0, 1]))
                    lo, hi = max(top, at[a] - 8), min(bottom, at[b - 1] + 9)
                    near = [data[x:y].tobytes().decode("utf-8", "replace").lower() for x, y in zip(start[lo:hi], end[lo:hi], strict=True)]
                    seen, row = set(), text[at[a]]
                    for x, y, family, p, share, notice in model.found(near):
                        number = int(line[lo + x] - np.searchsorted(breaks, offsets[row]))
                        if (number, family) not in seen:
                            seen.add((number, family))
                            passage = data[start[max(top, lo + x - 6)] : end[min(bottom, lo + y + 6) - 1]].tobytes().decode("utf-8", "replace")
                            rows.append((batch.column("doc_id")[int(i + row)].as_py(), number, family, p, share, notice, passage))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in _FOUND.split(", ")])

    return run


def licences(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The licence notices in ``docs`` (``doc_id``, ``text``): one row for each notice, with the ``line`` (from 0) where
    it begins, the ``family``, its calibrated ``probability``, the ``notice`` that confirms it, how much of that the
    passage has (``similarity``), and the ``passage``.

    - Null, empty or wordless texts have none. Null ``doc_id`` is carried as null; repeated rows are each scanned.
    - A notice may go over several lines, and a line hold several families, each once; a very long one is scanned whole. An empty table gives no rows, and
      other columns are ignored. Equal probabilities go to the first family in the list of notices.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return base.mapInArrow(_scanned(fit(base, sample)), _FOUND)
