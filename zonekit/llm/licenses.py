"""6. License scans: a trained paragraph classifier with an unknown class, confirmed by templates.

Paragraphs are the lines of a text, and the runs of lines without an empty one between them (comment markers hold no words); a longer
one is taken in windows of ``WINDOW`` words, half of which overlap. Features are the words and word pairs of the templates, counted
and divided by the square root of the paragraph's words, as sparse rows. A multinomial logistic regression gives the family or
``unknown``; a temperature and the least probability of a known family are calibrated on held-out paragraphs so that at most
``FALSE_RATE`` of the unknown ones pass. A passing paragraph is confirmed if it holds ``CONTAINED`` of the word pairs of a template of
that family; without confirmation it is reported as unknown. A run of lines counts where none of its lines tells the same. A paragraph without a word pair of any
template can neither pass for good nor be confirmed and isn't scored. The time is linear in the text.

``train`` makes its paragraphs: templates with words dropped, cut and added, and as unknown ones lines of the ``SAMPLE_DOCS`` documents
with the least hashes (a bounded sample) and sentences that use the same words for other things.

Null text counts as empty and has no paragraphs with words. Rows, repeated rows and other columns stay; a result column replaces one
of its name. An empty table trains on the templates alone and stays empty.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled
from .pieces import in_passes

SAMPLE_DOCS, MADE, FALSE_RATE, CONTAINED = 200, 6000, 0.001, 0.6
STEPS, PENALTY = 300, 1e-4
#: Words of the longest paragraph that is scored as one; tokens that are scored at a time (bounds memory only).
WINDOW, SLICE = 128, 200_000

#: Usual short notices of licence families.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "Licensed under a Creative Commons Attribution ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "Licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0)."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # headings
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD", "BSD 3-Clause License"),
    ("BSD", "BSD 2-Clause License"),
    ("ISC", "ISC License"),
    ("CC-BY", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0", "CC0 1.0 Universal"),
    # later sentences of full notices
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND."),
    ("GPL-3.0", "You should have received a copy of the GNU General Public License along with this program. If not, see www.gnu.org/licenses."),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0."),
    # identifiers
    *[(family, f"SPDX-License-Identifier: {name}") for family, names in (
        ("MIT", ["MIT"]), ("Apache-2.0", ["Apache-2.0"]), ("GPL-3.0", ["GPL-3.0-only", "GPL-3.0-or-later"]), ("GPL-2.0", ["GPL-2.0-only", "GPL-2.0-or-later"]),
        ("LGPL", ["LGPL-2.1-only", "LGPL-3.0-or-later"]), ("AGPL-3.0", ["AGPL-3.0-only"]), ("MPL-2.0", ["MPL-2.0"]), ("BSD", ["BSD-3-Clause", "BSD-2-Clause"]),
        ("ISC", ["ISC"]), ("CC-BY", ["CC-BY-4.0"]), ("CC-BY-SA", ["CC-BY-SA-4.0"]), ("CC0", ["CC0-1.0"]), ("Unlicense", ["Unlicense"])) for name in names],
]
#: Sentences that use such words for other things.
OTHER = ["A driving license is required for this job.", "The license plate of the car was not legible.", "The terms of the contract are under review.",
         "This work is part of a larger version of the story.", "Any person may obtain a copy at the general office.", "The public is free to use the library.",
         "The software was released in version 3 of the system.", "He was granted permission to leave, free of charge.", "All rights to the source are with the office.",
         "The license identifier on the form was wrong.", "MIT is a school in Boston and the license office is near it.", "A public notice in the general library.",
         "The author of this file has released no other work.", "Version 2.0 of the program is under way.", "The Apache helicopter and the foundation of the city."]

FAMILIES = ["unknown", *dict.fromkeys(f for f, _ in TEMPLATES)]
FOUND = "array<struct<paragraph int, family string, probability double, contained double, confirmed boolean>>"
_TOKENS = re.compile(r"\n|[a-z0-9]+").findall
_WORDS = re.compile(r"[a-z0-9]+").findall


class Vocabulary:
    """Words and word pairs of the templates as features."""

    def __init__(self):
        texts = [_WORDS(t.lower()) for _, t in TEMPLATES]
        self.word = {"\n": 1} | {w: i + 2 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.size = len(self.word) + 2
        pairs = sorted({(self.word[a], self.word[b]) for t in texts for a, b in zip(t, t[1:])})
        self.pair = np.full(self.size * self.size, -1, np.int32)
        for i, (a, b) in enumerate(pairs):
            self.pair[a * self.size + b] = self.size + i
        self.features = self.size + len(pairs)
        self.templates = [{int(self.pair[self.word[a] * self.size + self.word[b]]) for a, b in zip(t, t[1:])} for t in texts]

    def codes(self, text: str) -> np.ndarray:
        """Words as numbers (0: none of the vocabulary), 1 at the end of a line."""
        get = self.word.get
        return np.array([get(t, 0) for t in _TOKENS(text.lower())], np.int64)

    def pairs(self, codes: np.ndarray) -> np.ndarray:
        """Feature of each pair of neighbours, -1 where it is none."""
        return self.pair[codes[:-1] * self.size + codes[1:]]

    def sparse(self, paragraphs: list[np.ndarray]) -> Sparse:
        """Features of paragraphs given as codes."""
        c = np.concatenate(paragraphs) if paragraphs else np.empty(0, np.int64)
        n = np.array([len(p) for p in paragraphs], np.int64)
        ends = np.cumsum(n)
        p = np.append(self.pairs(c), -1) if len(c) else c
        p[ends[n > 0] - 1] = -1  # no pair goes over an end
        return Sparse.of(c, p, ends - n, ends, self.features)


@dataclass
class Sparse:
    """Rows of counts: features ``column`` (repeats count each) of row i at ptr[i]:ptr[i + 1], each with weight ``scale[i]``."""
    ptr: np.ndarray
    column: np.ndarray
    scale: np.ndarray
    features: int

    @classmethod
    def of(cls, codes: np.ndarray, pairs: np.ndarray, starts: np.ndarray, ends: np.ndarray, features: int) -> Sparse:
        """Rows of the words starts[i] to ends[i] and of the pairs that begin at all of them but the last."""
        def ranges(a: np.ndarray, b: np.ndarray, values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
            n = np.maximum(b - a, 0)
            at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, found = np.repeat(np.arange(len(a)), n), values[at]
            return row[found >= least], found[found >= least]
        rows, columns = zip(ranges(starts, ends, codes, 2), ranges(starts, ends - 1, pairs, 0))
        row, column = np.concatenate(rows), np.concatenate(columns)
        order = np.argsort(row, kind="stable")
        return cls(np.searchsorted(row[order], np.arange(len(starts) + 1)), column[order], 1 / np.sqrt(np.maximum(1, ends - starts)), features)

    def take(self, rows: np.ndarray) -> Sparse:
        n = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(n)])
        return Sparse(ptr, self.column[np.repeat(self.ptr[rows] - ptr[:-1], n) + np.arange(ptr[-1])], self.scale[rows], self.features)

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.ptr) - 1, weights.shape[1]))
        some = self.ptr[1:] > self.ptr[:-1]
        if some.any():
            out[some] = np.add.reduceat(weights[self.column], self.ptr[:-1][some], axis=0)
        return out * self.scale[:, None]

    def transposed(self):
        """A function e -> features x classes: the sums of ``e`` over the rows of each feature."""
        row = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        order = np.argsort(self.column, kind="stable")
        row, column = row[order], self.column[order]
        heads = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) if len(column) else np.empty(0, np.int64)

        def apply(e: np.ndarray) -> np.ndarray:
            out = np.zeros((self.features, e.shape[1]))
            if len(heads):
                out[column[heads]] = np.add.reduceat((e * self.scale[:, None])[row], heads, axis=0)
            return out
        return apply


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    held_out: dict = field(default_factory=dict)

    def probabilities(self, x: Sparse) -> np.ndarray:
        z = (x.times(self.weights) + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def made(lines: list[str], seed: int = 23) -> list[tuple[str, int]]:
    """Paragraphs and their families."""
    r, out = random.Random(seed), []
    filler = [w for line in lines for w in line.split()] or ["some", "other", "words"]
    for _ in range(MADE):
        if r.random() < 0.5:
            family, text = r.choice(TEMPLATES)
            words = [w for w in text.split() if r.random() > 0.05]
            if len(words) > 12 and r.random() < 0.5:
                words = words[:r.randint(10, len(words))]
            if r.random() < 0.5:
                words = r.sample(filler, min(len(filler), r.randint(0, 6))) + words + r.sample(filler, min(len(filler), r.randint(0, 6)))
            out.append((" ".join(words), FAMILIES.index(family)))
        elif lines and r.random() < 0.7:
            out.append((r.choice(lines), 0))
        else:
            words = r.choice(OTHER).split()
            out.append((" ".join(w for w in words if r.random() > 0.1) + " " + " ".join(r.sample(filler, min(len(filler), r.randint(0, 8)))), 0))
    return out


def train(df: DataFrame, text: str = "text") -> Model:
    """Fit and calibrate on made paragraphs; lines that hold a template word pair of a licence are not taken as unknown."""
    vocabulary = Vocabulary()
    marks = re.compile(r"(?i)licen[sc]e|copyright|creative commons|public domain")
    lines = [x for t in sampled(df, text, SAMPLE_DOCS) for x in t.split("\n") if x.strip() and not marks.search(x)]
    data = made(lines)
    x = vocabulary.sparse([vocabulary.codes(t) for t, _ in data])
    y = np.array([f for _, f in data])
    held = np.arange(len(y)) % 4 == 0
    w, b = np.zeros((x.features, len(FAMILIES))), np.zeros(len(FAMILIES))
    fit, truth = x.take(np.flatnonzero(~held)), np.eye(len(FAMILIES))[y[~held]]
    back, count = fit.transposed(), int((~held).sum())
    mean_w, mean_b, step = np.zeros_like(w), np.zeros_like(b), 4.0
    for _ in range(STEPS):  # gradient steps with momentum
        z = fit.times(w) + b
        z = np.exp(z - z.max(1, keepdims=True))
        e = (truth - z / z.sum(1, keepdims=True)) / count
        mean_w, mean_b = 0.9 * mean_w + back(e) - PENALTY * w, 0.9 * mean_b + e.sum(0)
        w, b = w + step * mean_w, b + step * mean_b
    check = x.take(np.flatnonzero(held))
    model = Model(vocabulary, w, b, 1.0, 0.5)
    losses = {}
    for t in np.geomspace(0.25, 4, 25):
        model.temperature = float(t)
        p = model.probabilities(check)
        losses[float(t)] = -np.log(np.maximum(p[np.arange(len(p)), y[held]], 1e-12)).mean()
    model.temperature = min(losses, key=losses.get)
    p = model.probabilities(check)
    wrong = np.sort(p[y[held] == 0][:, 1:].max(1))[::-1]
    model.least = float(max(0.5, np.nextafter(wrong[int(FALSE_RATE * len(wrong))], 1))) if len(wrong) else 0.5
    best = np.where(p[:, 1:].max(1) >= model.least, 1 + p[:, 1:].argmax(1), 0)
    model.held_out = {"accuracy": float((best == y[held]).mean()), "paragraphs": int(held.sum())}
    return model


def windows(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows over each run of equal values: one for a run of up to WINDOW words."""
    heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    ends = np.append(heads[1:], len(run))
    half = WINDOW // 2
    n = np.where(ends - heads <= WINDOW, 1, -(-(ends - heads - WINDOW) // half) + 1)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(heads, n) + half * nth
    return starts, np.minimum(starts + WINDOW, np.repeat(ends, n))


def scored(codes: np.ndarray, pairs: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: Model) -> Iterator[tuple[int, int, int, float]]:
    """(start, end, family, probability) of the windows that pass for a known family."""
    known = np.concatenate([[0], np.cumsum(pairs >= 0)])
    hit = np.flatnonzero(known[np.maximum(ends - 1, starts)] > known[starts])
    size = np.cumsum(ends[hit] - starts[hit])
    for part in np.split(hit, np.searchsorted(size, np.arange(SLICE, size[-1] if len(size) else 0, SLICE))):
        if not len(part):
            continue
        p = model.probabilities(Sparse.of(codes, pairs, starts[part], ends[part], model.vocabulary.features))
        best = 1 + p[:, 1:].argmax(1)
        high = p[np.arange(len(p)), best]
        for i in np.flatnonzero(high >= model.least):
            yield int(starts[part[i]]), int(ends[part[i]]), int(best[i]), float(high[i])


def scan_texts(texts: list[str], model: Model) -> list[tuple[int, list[dict]]]:
    """For each text its lines with words, and what is found in them; ``paragraph`` counts all lines from 0."""
    v = model.vocabulary
    each = [v.codes(t) for t in texts]
    sizes = np.array([len(c) + 2 for c in each], np.int64)  # two line ends part two texts
    codes = np.concatenate([x for c in each for x in (c, np.ones(2, np.int64))]) if each else np.empty(0, np.int64)
    text = np.repeat(np.arange(len(each)), sizes)
    end = codes == 1
    line, first = np.cumsum(end) - end, np.cumsum(sizes) - sizes
    c, at, of = codes[~end], line[~end], text[~end]
    base = line[first] if len(first) else first  # line numbers start anew in each text
    lines = np.bincount(of[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else of, minlength=len(each))
    found: list[list[dict]] = [[] for _ in each]
    if len(c) < 2:
        return [(int(n), f) for n, f in zip(lines, found)]
    pairs = np.append(np.where(np.diff(at) > 1, -1, v.pairs(c)), -1)  # an empty line ends a paragraph
    inner = np.where(np.append(np.diff(at) > 0, True), -1, pairs)     # pairs within a line
    block = np.concatenate([[0], np.cumsum(np.diff(at) > 1)])
    several = np.bincount(block[np.concatenate([[True], at[1:] != at[:-1]])]) > 1
    of_family = [[t for t, (f, _) in zip(v.templates, TEMPLATES) if f == family] for family in FAMILIES]

    def told(own: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, dict]]:
        out: list[tuple[int, int, dict]] = []
        for a, b, family, p in scored(c, own, starts, ends, model):
            mine = own[a:b - 1]
            near = set(mine.tolist())
            contained, template = max(((len(near & t) / len(t), i) for i, t in enumerate(of_family[family])), default=(0.0, -1))
            sure = contained >= CONTAINED
            held = np.flatnonzero(np.isin(mine, list(of_family[family][template]))) if contained else [0]
            place = a + int(held[0])
            one = {"paragraph": int(at[place] - base[of[place]]), "family": FAMILIES[family] if sure else "unknown", "probability": p,
                   "contained": contained, "confirmed": sure}
            if out and a < out[-1][1] and out[-1][2]["family"] == one["family"]:  # the same notice in two windows
                if one["contained"] > out[-1][2]["contained"]:
                    out[-1] = (out[-1][0], b, one | {"paragraph": out[-1][2]["paragraph"]})
                continue
            out.append((a, b, one))
        return out

    singles = told(inner, *windows(at))
    starts, ends = windows(block)
    wide = several[block[starts]]
    at_start = np.array([a for a, _, _ in singles], np.int64)
    gone = set()
    for a, b, one in told(pairs, starts[wide], ends[wide]):
        inside = range(int(np.searchsorted(at_start, a)), int(np.searchsorted(at_start, b)))
        if one["confirmed"]:
            if any(singles[i][2]["family"] == one["family"] for i in inside):
                continue
            gone |= {i for i in inside if not singles[i][2]["confirmed"]}
        elif len(inside):
            continue
        found[of[a]].append(one)
    for i, (a, _, one) in enumerate(singles):
        if i not in gone:
            found[of[a]].append(one)
    for f in found:
        f.sort(key=lambda x: (x["paragraph"], x["family"]))
    return [(int(n), f) for n, f in zip(lines, found)]


def scan(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with n_paragraphs (lines with words) and licences (paragraphs that pass, confirmed or not)."""
    kind = pa.struct([("n", pa.int64()), ("found", pa.list_(pa.struct([
        ("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64()), ("confirmed", pa.bool_())])))])

    @F.arrow_udf(f"struct<n bigint, found {FOUND}>")
    def scanned(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        return pa.array([{"n": n, "found": f} for part in in_passes(texts) for n, f in scan_texts(texts[part], model)], kind)

    out = df.drop("n_paragraphs", "licences").withColumn("_scan", scanned(F.col(text).cast("string")))
    return out.withColumn("n_paragraphs", F.col("_scan.n")).withColumn("licences", F.col("_scan.found")).drop("_scan")
