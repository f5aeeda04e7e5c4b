"""License scans by a trained paragraph classifier.

A paragraph (a line of a text that has a word) is classified by multinomial logistic regression on hashed, weighted
word 1- and 2-grams. It is trained here: on excerpts of the templates below for the licence families, and for the class
``none`` on a bounded sample of paragraphs of the corpus that contain no template. Probabilities are calibrated by a temperature
of least log loss over templates and paragraphs that were left out of the training.

A licence is looked for where it stands, however long the paragraph is: a template (a notice, or a sentence of a licence)
is contained if a run of words of about its length has enough of its word pairs, among them one that only its family has. The classifier
judges that run. A family counts if the run contains a template of it and it reaches THRESHOLD; a run of which no family
counts is ``unknown``, and so is a paragraph without such runs if its words around the most template pairs look more
like a licence than like text. A paragraph may have several families.

Defined results: null and empty texts have no paragraphs and licence ``none``; equal probabilities go to the first family
in alphabetical order; rows are judged one by one; very long paragraphs are classified whole. Only the columns asked for are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1 << 14
SAMPLE = 4000  # paragraphs of the corpus to learn ``none`` from: those of the smallest hash
SAMPLE_CHARS = 4000  # longer paragraphs are not learned from, so that the driver holds a bounded sample; all are scanned, whole
EXCERPTS = 120  # of each family
EPOCHS = 12
FOLDS = 3  # for the calibration
THRESHOLD = 0.5
CONFIRMED = 0.6  # of a template's word pairs, in a run of the paragraph
LOOSE = 1.25, 6  # such a run has at most so many times the template's words, and so many more
AROUND = 32  # words that are judged where no template is contained
NONE, UNKNOWN = "none", "unknown"
WORD = regex.compile(r"[\p{L}\p{N}]+")
SPELLED = {"licence": "license", "licences": "licenses", "licenced": "licensed"}

# fixed values: notices by which the families are recognised
TEMPLATES = {
    "Apache": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "Licensed under the Apache License, Version 2.0.", "Released under the Apache 2.0 license.",
               "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", "Released under the BSD 3-Clause License.", "Licensed under the BSD license.",
            "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
              "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "Released under CC0 1.0 Universal, public domain dedication."],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GPL version 2 or later.",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation.", "Licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction", "Released under the MIT License.",
            "Licensed under the MIT license.", "SPDX-License-Identifier: MIT"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License, version 2.0."],
}
# fixed values: further sentences of the licences' texts, and other wordings of notices
SENTENCES = {
    "Apache": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
               "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
               "See the License for the specific language governing permissions and limitations under the License.",
               "Available under the Apache License 2.0.", "Licensed under Apache 2.0.", "Apache License Version 2.0, January 2004",
               "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
               "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of"],
    "BSD": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
            "disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
            "Licensed under BSD-3-Clause.", "Available under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "CC-BY": ["Available under a Creative Commons Attribution license.", "Creative Commons Attribution-ShareAlike 4.0 International License",
              "You are free to share and adapt the material for any purpose, even commercially, as long as you give appropriate credit"],
    "CC-BY-NC": ["Available under a Creative Commons Attribution-NonCommercial license.",
                 "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
                 "You may not use the material for commercial purposes"],
    "CC0": ["has waived all copyright and related or neighboring rights to this work", "Licensed under CC0 1.0.",
            "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her "
            "rights to the work worldwide under copyright law"],
    "GPL": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
            "You should have received a copy of the GNU General Public License along with this program.",
            "Released under the GNU GPL v3.", "Licensed under the GPLv3.", "Licensed under GPL-3.0."],
    "LGPL": ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
             "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
             "as published by the Free Software Foundation; either version 2.1 of the GNU Lesser General Public License, or (at your "
             "option) any later version.", "Licensed under the LGPL version 2.1 or later.", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "MIT": ["including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
            "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE",
            "Available under the terms of the MIT License.", "Licensed under MIT."],
    "MPL": ["If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
            "Licensed under the MPL 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}
FAMILIES = sorted(TEMPLATES)
CLASSES = [*FAMILIES, NONE]


def words_of(text: str) -> list[str]:
    return [SPELLED.get(w, w) for w in WORD.findall(text.lower())]


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


ALL_PAIRS = {p for ts in TEMPLATES.values() for t in ts for p in pairs(words_of(t))}
KNOWN = [(f, pairs(words_of(t)), len(words_of(t))) for f in FAMILIES for t in (*TEMPLATES[f], *SENTENCES[f])]
NAMELESS = {"version", "v", "license", "licensed", "under", "the"}  # with numbers, these tell no family


def by_pair(known: list[tuple[str, set[tuple[str, str]], int]]) -> tuple[dict[tuple[str, str], list[int]], dict[tuple[str, str], str]]:
    """Templates by word pair, and the family of the pairs that only one family has."""
    has: dict[tuple[str, str], list[int]] = {}
    for k, (_, of, _) in enumerate(known):
        for p in of:
            has.setdefault(p, []).append(k)
    named = {p for p in has if not all(w in NAMELESS or w.isdigit() for w in p)}
    return has, {p: known[has[p][0]][0] for p in named if len({known[k][0] for k in has[p]}) == 1}


HAS, OWN = by_pair(KNOWN)
VOCABULARY = {w for ts in TEMPLATES.values() for t in ts for w in words_of(t)}


def vector(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a paragraph's features, of unit length."""
    grams = [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]
    at, n = np.unique([zlib.crc32(g.encode()) % DIMENSIONS for g in grams], return_counts=True)
    value = np.log1p(n)
    return at, value / np.linalg.norm(value)


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def contained(words: list[str]) -> list[tuple[int, int, str]]:
    """(begin, end, family) of the runs of words that contain a template, in order; the fullest, then first one of a template's
    overlapping runs."""
    places: dict[int, list[int]] = {}
    for i, p in enumerate(zip(words, words[1:])):
        for k in HAS.get(p, ()):
            places.setdefault(k, []).append(i)
    out = []
    for k, at in places.items():
        family, wanted, size = KNOWN[k]
        if len(at) < CONFIRMED * len(wanted):
            continue
        longest, low, runs = int(size * LOOSE[0]) + LOOSE[1], 0, []
        inside: dict[tuple[str, str], int] = {}
        own = 0
        for i in at:
            p = words[i], words[i + 1]
            inside[p] = inside.get(p, 0) + 1
            own += OWN.get(p) == family
            while i + 2 - at[low] > longest:
                q = words[at[low]], words[at[low] + 1]
                inside[q] -= 1
                own -= OWN.get(q) == family
                if not inside[q]:
                    del inside[q]
                low += 1
            if own and len(inside) >= CONFIRMED * len(wanted):
                run = (len(inside), at[low], i + 2)
                if runs and run[1] < runs[-1][2]:
                    runs[-1] = max(runs[-1], run, key=lambda r: r[0])
                else:
                    runs.append(run)
        out += [(begin, end, family) for _, begin, end in runs]
    return sorted(out)


def excerpts(rng: np.random.Generator) -> tuple[list[list[str]], list[int], list[int]]:
    """Cut and damaged copies of the templates, as notices appear in texts: words, family, and place of the template in its family."""
    texts, labels, sources = [], [], []
    for k, family in enumerate(FAMILIES):
        of = (*TEMPLATES[family], *SENTENCES[family])
        for n in range(EXCERPTS):
            words = words_of(of[n % len(of)])
            if n >= len(of) and len(words) > 8:
                begin = int(rng.integers(0, len(words) // 3))
                words = words[begin:begin + max(8, int(len(words) * rng.uniform(0.5, 1)))]
                words = [w for w in words if rng.random() > 0.05] or words
            texts.append(words)
            labels.append(k)
            sources.append(n % len(of))
    return texts, labels, sources


def class_weights(labels: np.ndarray) -> np.ndarray:
    """Rare classes weigh as much as the common one."""
    return len(labels) / (len(CLASSES) * np.bincount(labels, minlength=len(CLASSES)).clip(1))


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least mean log loss, classes weighing alike; within a factor of 1.1."""
    weight, best = class_weights(labels)[labels], (np.inf, 1.0)
    for t in 1.1 ** np.arange(-15, 31):
        z = scores / t
        z = z - z.max(axis=1, keepdims=True)
        loss = np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]
        best = min(best, (float((weight * loss).sum()), float(t)))
    return best[1]


class Classifier:
    """Trained on excerpts of all templates and on plain paragraphs. The temperature is that of least log loss over items whose
    template had no part in the training: the templates of each family are dealt into FOLDS, and so are the plain paragraphs."""

    def __init__(self, plain: list[list[str]]):
        rng = np.random.default_rng(7)
        texts, labels, sources = excerpts(rng)
        for n, words in enumerate(plain):
            texts.append(words)
            labels.append(len(FAMILIES))
            sources.append(n)
        vectors, labels, folds = [vector(t) for t in texts], np.array(labels), np.array(sources) % FOLDS
        scores = np.zeros((len(vectors), len(CLASSES)))
        for fold in range(FOLDS):
            self.train(rng, vectors, labels, np.flatnonzero(folds != fold))
            for i in np.flatnonzero(folds == fold):
                scores[i] = self.scores(*vectors[i])
        self.temperature = calibrated(scores, labels)
        self.train(rng, vectors, labels, np.arange(len(vectors)))

    def train(self, rng: np.random.Generator, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, used: np.ndarray) -> None:
        self.weights = np.zeros((DIMENSIONS, len(CLASSES)))
        self.bias = np.zeros(len(CLASSES))
        weight = class_weights(labels)
        for epoch in range(EPOCHS):
            step = 2.0 / (1 + epoch)
            for i in rng.permutation(used):
                at, value = vectors[i]
                error = self.softmax(self.scores(at, value))
                error[labels[i]] -= 1
                rate = step * min(4.0, weight[labels[i]])
                self.weights[at] -= rate * value[:, None] * error
                self.bias -= 0.1 * rate * error

    @staticmethod
    def softmax(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max())
        return e / e.sum()

    def scores(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return value @ self.weights[at] + self.bias

    def probabilities(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return self.softmax(self.scores(at, value) / self.temperature)

    def found(self, paragraph: str) -> list[tuple[str, float]]:
        """The families in order of first appearance, each with its highest probability; or ``unknown``; or nothing."""
        words = words_of(paragraph)
        hits = [i for i, p in enumerate(zip(words, words[1:])) if p in HAS]
        if not hits:
            return []
        out: dict[str, float] = {}
        unknown, runs = 0.0, contained(words)
        known: dict[tuple[int, int], np.ndarray] = {}
        for begin, end, family in runs:
            if (begin, end) not in known:
                known[begin, end] = self.probabilities(*vector(words[begin:end]))
            p = known[begin, end]
            at = FAMILIES.index(family)
            if p[:-1].argmax() == at and p[at] >= THRESHOLD:
                out[family] = max(out.get(family, 0.0), float(p[at]))
            unknown = max(unknown, float(1 - p[-1]))
        if out or runs:
            return list(out.items()) or [(UNKNOWN, unknown)]
        # looks like a licence: it must at least share some wording with one
        hits, low, best = [i for i in hits if (words[i], words[i + 1]) in ALL_PAIRS], 0, (0, 0)
        for n, i in enumerate(hits):
            while i - hits[low] > AROUND - 2:
                low += 1
            best = max(best, (n - low + 1, -hits[low]))
        begin = max(0, min(-best[1], len(words) - AROUND))
        near = words[begin:begin + AROUND]
        own = pairs(near)
        if len(own & ALL_PAIRS) * 4 < max(1, len(own)):
            return []
        p = self.probabilities(*vector(near))
        return [(UNKNOWN, float(1 - p[-1]))] if p[:-1].max() > p[-1] else []

    def judge(self, paragraph: str) -> tuple[str, float]:
        """The most probable family, ``unknown`` or ``none``, and its probability."""
        return max(self.found(paragraph), key=lambda f: f[1], default=(NONE, 1.0))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Classifier:
    """Learns from at most ``sample`` different paragraphs of up to ``sample_chars`` that contain no template.

    They are those of the smallest hashes. A bound on the hash that leaves about twice as many comes first, so that tasks
    hand over few paragraphs however many tasks there are, and a paragraph with many copies counts once.
    """
    lines = docs.select(F.explode(paragraphs(F.col(text))).alias("p")).where(
        (F.length(F.trim("p")) > 0) & (F.length("p") <= sample_chars)).select("p", F.xxhash64("p").alias("h"))
    different = lines.agg(F.approx_count_distinct("h")).first()[0]
    if different > 2 * sample:
        lines = lines.where(F.col("h") < int(-2 ** 63 + 2 ** 64 * (2 * sample / different)))
    found = [words_of(r["p"]) for r in lines.distinct().orderBy("h", "p").limit(sample).collect()]
    return Classifier([words for words in found if words and not contained(words)])


def scan(docs: DataFrame, classifier: Classifier, text: str = "text", into: str = "licence") -> DataFrame:
    """All columns, and a struct ``into``: ``families`` of the confirmed paragraphs in order of first appearance, the most
    probable one as ``licence``, its ``probability``, and how many paragraphs are licences of a known or unknown family."""

    @F.pandas_udf("licence string, probability double, families array<string>, n_paragraphs int, n_unknown int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                found: dict[str, float] = {}
                known = unknown = 0
                for p in (value or "").split("\n"):
                    of_paragraph = classifier.found(p)
                    if not of_paragraph:
                        continue
                    is_unknown = of_paragraph[0][0] == UNKNOWN
                    known, unknown = known + (not is_unknown), unknown + is_unknown
                    for family, probability in of_paragraph:
                        found[family] = max(found.get(family, 0.0), probability)
                named = {k: v for k, v in found.items() if k != UNKNOWN}
                best = max(named, key=lambda k: (named[k], [-ord(c) for c in k])) if named else UNKNOWN if found else NONE
                rows.append((best, found.get(best, 1.0), list(named), known, unknown))
            yield pd.DataFrame(rows, columns=["licence", "probability", "families", "n_paragraphs", "n_unknown"])

    return docs.withColumn(into, of(F.col(text)))
