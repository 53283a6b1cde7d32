"""Licence notices in documents: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line. Its features are the word 1- to 3-grams that occur in the templates and hold a word
that is no stop word; a multinomial logistic regression over them names a licence family or
``unknown``. It is trained on templates, on altered copies of them (words dropped, cut at either end, set between
other words) and, for ``unknown``, on paragraphs of the corpus and on sentences that only sound alike.
A temperature and the least probability are calibrated on copies that the fit has not seen. A named family
counts only if enough word pairs of one of its templates stand in the paragraph.

The fit uses at most ``background_rows`` paragraphs, those with the smallest hash; every paragraph is scored.
"""
from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pulserank.llm.common import column_free, pieces

UNKNOWN = "unknown"
BACKGROUND_ROWS, PRECISION, COPIES = 1_000, 0.99, 24
_WORDS = re.compile(r"[a-z0-9]+(?:[.\-+][a-z0-9]+)*").findall

# Sentences by which public licences are announced.
TEMPLATES = {
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under the CC0 1.0 Universal public domain dedication.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Released under the ISC License.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "reserved": ("All rights reserved.", "Copyright (c) 2020. All rights reserved.", "No part of this publication may be reproduced without prior written permission."),
}
SOUND_ALIKE = (
    "A driving licence is required to rent the car.", "The licence of the restaurant was renewed in version two of the contract.",
    "She asked for permission to use the software at work.", "The general public was not allowed to copy the files.",
    "Apache tribes lived in this region, and the free software talk was about the foundation.", "The MIT campus released a report.",
    "He holds a fishing license issued by the state.", "The new version of the program is distributed in May.",
    "A copy of the letter was obtained from the file.", "Creative work is common in public life.", "The author has waived the fee for students.",
    "Source code and binary files are stored in the cloud.", "All seats are reserved.", "The mozilla team published a document.",
)
STOP = frozenset("a an and any are as at be by can for from has have if in is it no not of on or out that the this to under was with you your may all de la le und der die que el en les des".split())


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1) if not STOP.issuperset(words[i:i + n])}


def words_of(paragraph: str) -> list[str]:
    return _WORDS(paragraph.lower())


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:])) or {tuple(words)}


@dataclass
class Classifier:
    families: list[str]
    places: dict[str, int]
    weights: np.ndarray  # a row per feature and, last, the bias
    temperature: float
    least: float
    confirm: float

    def __post_init__(self):
        self.cues = {w for g in self.places for w in g.split(" ") if w not in STOP}
        self.templates = {f: [_pairs(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}

    def probabilities(self, words: list[str]) -> np.ndarray:
        rows = [self.places[g] for g in grams(words) if g in self.places]
        z = (self.weights[rows].sum(axis=0) + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def likeness(self, family: str, words: list[str]) -> float:
        """The largest share of a template's word pairs that the paragraph holds."""
        pairs = _pairs(words)
        return max(len(t & pairs) / len(t) for t in self.templates[family])

    def classify(self, paragraph: str) -> tuple[str, float, float] | None:
        """(family, probability, likeness), or None for unknown ones."""
        words = words_of(paragraph)
        if self.cues.isdisjoint(words):
            return None
        p = self.probabilities(words)
        best = int(p.argmax())
        if self.families[best] == UNKNOWN or p[best] < self.least:
            return None
        likeness = self.likeness(self.families[best], words)
        return (self.families[best], float(p[best]), likeness) if likeness >= self.confirm else None

    def scan(self, text: str | None) -> list[tuple[int, int, str, float, float]]:
        """(start, end, family, probability, likeness) of the notices of a text, in code points."""
        text = text or ""
        if self.cues.isdisjoint(_WORDS(" ".join(set(text.lower().split())))):
            return []
        found, start = [], 0
        for line in text.split("\n"):
            named = self.classify(line)
            if named:
                found.append((start, start + len(line), *named))
            start += len(line) + 1
        return found


def _altered(words: list[str], others: list[list[str]], rng: random.Random) -> list[str]:
    out = [w for w in words if rng.random() > 0.08]
    cut = rng.random()
    if cut < 0.25 and len(out) > 6:
        out = out[rng.randrange(len(out) // 3):]
    elif cut < 0.5 and len(out) > 6:
        out = out[:len(out) - rng.randrange(len(out) // 3)]
    if others and rng.random() < 0.5:
        around = rng.choice(others)
        at = rng.randrange(len(around) + 1)
        out = around[max(0, at - 12):at] + out + around[at:at + 12]
    return out


def fit(background: list[str], copies: int = COPIES, confirm: float = 0.5, seed: int = 3) -> Classifier:
    """The classifier; ``background``: paragraphs of the corpus, of which those that resemble a template are left out."""
    rng = random.Random(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    known = [_pairs(words_of(t)) for ts in TEMPLATES.values() for t in ts]
    plain = [w for w in map(words_of, background) if w and not any(len(k & _pairs(w)) / len(k) >= 0.3 for k in known)]
    places = {g: i for i, g in enumerate(sorted({g for ts in TEMPLATES.values() for t in ts for g in grams(words_of(t))}))}
    rows, target, fold = [], [], []
    for label, family in enumerate(families[:-1]):
        for template in TEMPLATES[family]:
            words = words_of(template)
            for i in range(copies):
                rows.append(words if i < 2 else _altered(words, plain, rng))
                target.append(label)
                fold.append(i % 3)
    for i, words in enumerate([*(words_of(s) for s in SOUND_ALIKE for _ in range(4)), *plain]):
        rows.append(words if i % 4 == 0 else _altered(words, plain, rng))
        target.append(len(families) - 1)
        fold.append(i % 3)
    x = np.zeros((len(rows), len(places) + 1), np.float32)
    x[:, -1] = 1
    for i, words in enumerate(rows):
        x[i, [places[g] for g in grams(words) if g in places]] = 1
    y, fold = np.eye(len(families), dtype=np.float32)[target], np.array(fold)
    weights, speed = np.zeros((x.shape[1], len(families)), np.float32), 0
    a, b = x[fold > 0], y[fold > 0]
    for _ in range(250):
        z = a @ weights
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 0.5 * (a.T @ (p - b) / len(a) + 1e-5 * weights)
        weights = weights + speed
    z, labels = x[fold == 0] @ weights, np.array(target)[fold == 0]

    def softmax(t: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: -np.log(softmax(t)[np.arange(len(labels)), labels] + 1e-12).mean())
    p = softmax(temperature)
    best, top = p.argmax(1), p.max(1)
    named = best < len(families) - 1
    least = next((t for t in np.arange(0.3, 1.0, 0.02) if ((best == labels) & named & (top >= t)).sum() >= PRECISION * (named & (top >= t)).sum()), 0.98)
    return Classifier(families, places, weights, temperature, float(least), confirm)


def background(docs: DataFrame, text: str = "text", rows: int = BACKGROUND_ROWS) -> list[str]:
    """At most ``rows`` paragraphs of 4 to 80 words, those with the smallest hash."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1)).alias("line"))
    words = F.regexp_count("line", F.lit(" ")) + 1
    return [r.line for r in lines.where(words.between(4, 80)).orderBy(F.xxhash64("line"), "line").limit(rows).collect()]


def scan_licenses(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``notices``: array of (start, end, family, probability, likeness), in text order.

    Null and empty texts have none. A clash of names gives the new column an underscore in front. Other columns pass.
    """
    name = column_free(docs, "notices")
    kinds = {"start": (pa.int32(), T.IntegerType()), "end": (pa.int32(), T.IntegerType()), "family": (pa.string(), T.StringType()), "probability": (pa.float64(), T.DoubleType()), "likeness": (pa.float64(), T.DoubleType())}

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(rows, text):
            found = [[dict(zip(kinds, n)) for n in classifier.scan(t)] for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.struct([(k, v[0]) for k, v in kinds.items()])))], [*part.schema.names, name])

    notice = T.StructType([T.StructField(k, v[1]) for k, v in kinds.items()])
    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(notice))]))
