"""Licence scan: a trained paragraph classifier whose findings templates confirm.

Paragraphs are the lines of a text. A multinomial logistic regression over sparse
word n-grams (one to three words) gives each the probability of a licence family or
of none. It is trained here, on variants of the templates below and on a bounded
sample of lines from the documents (``SAMPLE_LINES`` lines of ``SAMPLE_DOCS`` documents,
drawn by hash); lines that resemble a template are left out of the sample. On held-out
variants a temperature calibrates the probabilities, and the least confidence at which
their precision reaches ``PRECISION`` becomes the threshold. A paragraph that is likely
some licence but below the threshold, or whose family's templates do not confirm it
(``CONFIRM`` of a template's word pairs must be present), is ``unknown`` if it still
resembles some template (``RESEMBLES``), and none otherwise.

Every paragraph of every text is classified. Words outside the model's vocabulary
carry no weight, so most paragraphs cost one lookup per word.

Defined results: null, empty and blank texts have no paragraphs and no licence.
Repeated rows are scanned one by one; a null key stays null; columns beside key and
text are not read. An empty table gives an empty result, and with no sample lines
the model is trained on templates alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import hashed_share, text_or_empty

# How the families are commonly worded.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "reserved": (
        "All rights reserved.",
        "Copyright 2020 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
    ),
}
NONE, UNKNOWN = "none", "unknown"
FAMILIES = (NONE, *TEMPLATES)
# Everyday sentences with licence words, which are no licences.
HARMLESS = (
    "She renewed her driving license last week.",
    "The license plate of the car was new and public.",
    "A free copy of the work is in the general library, version two.",
    "The general said that the public had the right to know.",
    "Permission to use the software was given under the following conditions.",
    "The city of Apache lies in the north and the university is near.",
    "All of the work was released in the following year.",
)
SAMPLE_DOCS = 2000
SAMPLE_LINES = 3000
VARIANTS = 24
VOCABULARY = 6000
PRECISION = 0.99
CONFIRM = 0.75
RESEMBLES = 0.3
SEED = 13
WORD = re.compile(r"[a-z0-9]+(?:[.+][0-9]+)*")


def words(line: str) -> list[str]:
    return WORD.findall(line.lower())


def grams(tokens: list[str]) -> list[str]:
    out = list(tokens)
    for n in (2, 3):
        out += [" ".join(tokens[i : i + n]) for i in range(len(tokens) - n + 1)]
    return out


def _pairs(line: str) -> set[tuple[str, str]]:
    tokens = words(line)
    return set(zip(tokens, tokens[1:]))


TEMPLATE_PAIRS = {f: [_pairs(t) for t in ts] for f, ts in TEMPLATES.items()}


def resemblance(line: str, family: str) -> float:
    """Largest share of a template's word pairs that the line holds."""
    own = _pairs(line)
    return max(len(own & pairs) / len(pairs) for pairs in TEMPLATE_PAIRS[family])


@dataclass
class Model:
    """Weights by n-gram and family, with temperature and threshold."""

    index: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def __post_init__(self):
        self.starts = {g.partition(" ")[0] for g in self.index}

    def features(self, line: str) -> list[int]:
        tokens = words(line)
        if self.starts.isdisjoint(tokens):
            return []
        return sorted({self.index[g] for g in grams(tokens) if g in self.index})

    def logits(self, features: list[int]) -> np.ndarray:
        # Features of a line are scaled to length one, as in training.
        if not features:
            return self.bias
        return self.weights[features].sum(axis=0) / len(features) ** 0.5 + self.bias

    def classify(self, line: str) -> tuple[str, float]:
        """Family (or none, or unknown) and the calibrated probability of the best licence."""
        features = self.features(line)
        z = self.logits(features) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p[1:].argmax()) + 1
        if p[0] >= 0.5:
            return NONE, float(p[best])
        family = FAMILIES[best]
        if p[best] >= self.threshold and resemblance(line, family) >= CONFIRM:
            return family, float(p[best])
        like = max(resemblance(line, f) for f in TEMPLATES)
        return UNKNOWN if like >= RESEMBLES else NONE, float(p[best])


def _variant(line: str, noise: list[str], rng: np.random.Generator) -> str:
    tokens = [t for t in line.split() if rng.random() > 0.06]
    cut = lambda: noise[rng.integers(len(noise))].split()[: rng.integers(0, 7)] if noise else []
    line = " ".join([*cut(), *tokens, *cut()])
    return line.upper() if rng.random() < 0.1 else line


def train(lines: list[str], seed: int = SEED, rounds: int = 120, rate: float = 2.0, decay: float = 1e-4) -> Model:
    """Fit on variants of the templates and on ``lines`` that resemble none."""
    rng = np.random.default_rng(seed)
    plain = [x for x in lines if all(resemblance(x, f) < RESEMBLES for f in TEMPLATES)]
    examples = [(x, 0) for x in plain] + [(_variant(h, plain, rng), 0) for h in HARMLESS for _ in range(VARIANTS)]
    for y, family in enumerate(TEMPLATES, start=1):
        for template in TEMPLATES[family]:
            examples += [(template, y)] + [(_variant(template, plain, rng), y) for _ in range(VARIANTS)]
    held = rng.random(len(examples)) < 0.2
    bags = [set(grams(words(x))) for x, _ in examples]
    # N-grams of licences or of harmless sentences; those of other text only if among the most frequent.
    counts = Counter(g for b, (_, y), h in zip(bags, examples, held) if not h for g in b)
    known = {g for ts in (*TEMPLATES.values(), HARMLESS) for t in ts for g in grams(words(t))}
    ranked = sorted(counts, key=lambda g: (g not in known, -counts[g], g))[:VOCABULARY]
    index = {g: i for i, g in enumerate(sorted(g for g in ranked if g in known or counts[g] > 4))}
    rows, columns, values = [], [], []
    for i, b in enumerate(bags):
        own = [index[g] for g in b if g in index]
        rows += [i] * len(own)
        columns += own
        values += [max(len(own), 1) ** -0.5] * len(own)
    x = np.zeros((len(examples), len(index)), dtype=np.float32)
    x[rows, columns] = values
    y = np.eye(len(FAMILIES), dtype=np.float32)[[c for _, c in examples]]
    w, bias = np.zeros((len(index), len(FAMILIES)), dtype=np.float32), np.zeros(len(FAMILIES), dtype=np.float32)
    xt, yt, speed, speed_bias = x[~held], y[~held], 0, 0
    weight = (len(yt) / (len(FAMILIES) * np.maximum(yt.sum(axis=0), 1)))[yt.argmax(axis=1)][:, None] ** 0.5
    for _ in range(rounds):
        z = xt @ w + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (p / p.sum(axis=1, keepdims=True) - yt) * weight / len(yt)
        speed = 0.9 * speed - rate * (xt.T @ slope + decay * w)
        speed_bias = 0.9 * speed_bias - rate * slope.sum(axis=0)
        w, bias = w + speed, bias + speed_bias
    model = Model(index, w.astype(np.float64), bias.astype(np.float64))
    return _calibrated(model, x[held] @ w + bias, y[held].argmax(axis=1))


def _calibrated(model: Model, z: np.ndarray, y: np.ndarray) -> Model:
    """Temperature by held-out likelihood; threshold by held-out precision."""

    def probabilities(t: float) -> np.ndarray:
        p = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    if not len(y):
        return model
    loss = lambda t: -np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))
    p = probabilities(model.temperature)
    best, sure = p[:, 1:].argmax(axis=1) + 1, p[:, 1:].max(axis=1)
    for threshold in np.arange(0.3, 1.0, 0.05):
        said = sure >= threshold
        if said.any() and (best[said] == y[said]).mean() >= PRECISION:
            break
    model.threshold = float(threshold)
    return model


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_lines: int = SAMPLE_LINES, seed: int = SEED) -> Model:
    """Model with a bounded sample of the documents' lines as its other class.

    About ``SAMPLE_DOCS`` documents are drawn by hash, and of their lines the first
    ``sample_lines`` in a seeded order.
    """
    share = SAMPLE_DOCS / max(docs.count(), SAMPLE_DOCS)
    some_docs = docs.filter(hashed_share(seed, key, text, share=share)) if share < 1 else docs
    lines = some_docs.select(F.explode(F.split(text_or_empty(text), "\n")).alias("line"))
    lines = lines.filter(F.length("line").between(1, 2000))
    order = F.xxhash64(F.lit(seed), "line")
    some = lines.orderBy(order, "line").limit(sample_lines).collect()
    return train([r["line"] for r in some], seed)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """One row per document: its licence families and where they stand.

    ``licences`` are the confirmed families in order, ``found`` lists every licence
    paragraph as family:start:end in code points, ``n_unknown`` counts those that are no
    known family, and ``confidence`` is the largest probability among confirmed ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, key, text))
    slim = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = {"licences": [], "found": [], "n_unknown": [], "n_paragraphs": [], "confidence": []}
            for text in batch.column(1):
                at, n, hits = 0, 0, []
                for line in text.as_py().split("\n"):
                    if line and not line.isspace():
                        n += 1
                        family, p = model.classify(line)
                        if family != NONE:
                            hits.append((family, at, at + len(line), p))
                    at += len(line) + 1
                sure = [h for h in hits if h[0] != UNKNOWN]
                out["licences"].append(",".join(sorted({h[0] for h in sure})))
                out["found"].append(",".join(f"{f}:{a}:{b}" for f, a, b, _ in hits))
                out["n_unknown"].append(len(hits) - len(sure))
                out["n_paragraphs"].append(n)
                out["confidence"].append(round(max((h[3] for h in sure), default=0.0), 6))
            kinds = {"licences": pa.string(), "found": pa.string(), "confidence": pa.float64()}
            arrays = [pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *out])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        run,
        f"doc_id {kind}, licences string, found string, n_unknown long, n_paragraphs long, confidence double",
    )
