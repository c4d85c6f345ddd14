"""Licence scan by a trained paragraph classifier, confirmed by template comparison.

A sparse logistic regression over hashed word unigrams and bigrams tells the licence families
of paragraphs (lines) apart, with an unknown class for all else.  Its positives are the
notices below with words dropped at random, short identifiers and the lines of the full texts in
licence_texts; its negatives are a bounded, hashed sample of distinct corpus paragraphs.  A temperature
fitted on held-out examples calibrates the probabilities.  Every paragraph with words is scored.

A family is confirmed where a window of the paragraph holds LEAST_SHARE of the word trigrams of a notice,
or a whole identifier, and the classifier gives the window to that family; else where the whole
paragraph is given to a family that has LEAST_SHARE of its trigrams.  A paragraph that a window, or
the classifier by words of which templates have LEAST_SHARE, takes for a licence, and that is not
confirmed, is reported as unknown.  So is one that names a licence outside the families, or another
version of theirs: no window that overlaps such a name confirms, nor does the whole paragraph.
"""

from __future__ import annotations

from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .decontamination import in_sorted

# Notices by licence family.  Fixed values.
NOTICES = {
    "agpl-3.0": ("This program is licensed under the GNU Affero General Public License, version 3.",),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Released under the BSD 3-Clause License.",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution License."),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial License.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under its terms.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",),
}
# Short forms that name a family by themselves, and what follows "SPDX-License-Identifier:".
IDENTIFIERS = {
    "agpl-3.0": ("AGPL-3.0", "AGPL 3", "AGPLv3", "GNU AGPL", "GNU Affero General Public License"),
    "apache-2.0": ("Apache-2.0", "Apache 2", "Apache License 2.0", "Apache License Version 2.0"),
    "bsd-3-clause": ("BSD-3-Clause", "3-Clause BSD", "New BSD License"),
    "cc-by-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "cc-by-nc-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "gpl-3.0": ("GPL-3.0", "GPL 3", "GPLv3", "GNU General Public License version 3", "GNU General Public License v3"),
    "mit": ("MIT License", "MIT Licence", "MIT licensed", "license MIT", "SPDX-License-Identifier: MIT"),
    "mpl-2.0": ("MPL-2.0", "MPL 2", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0"),
}
# Names of licences that are none of the families, or other versions of theirs.  Fixed values.
OTHERS = (
    "LGPL", "LGPLv2", "LGPLv3", "GNU Lesser General Public License", "GNU Library General Public License", "GPL 2", "GPLv2",
    "GPL version 2", "GNU General Public License version 2", "GNU General Public License v2", "ISC License", "ISC Licence",
    "BSD-2-Clause", "2-Clause BSD", "Simplified BSD License", "MPL 1.1", "Mozilla Public License version 1.1", "Apache License version 1.1",
    "CC BY-SA", "CC BY-ND", "CC BY-NC-SA", "CC BY-NC-ND", "Attribution-ShareAlike", "Attribution-NoDerivatives", "EUPL", "EPL 2.0",
    "Eclipse Public License", "Artistic License", "zlib License", "WTFPL",
)
TEXTS = Path(__file__).resolve().parent / "licence_texts"
FAMILIES = (*sorted(NOTICES), "unknown")
UNKNOWN = len(FAMILIES) - 1
CELLS = 1 << 11
VARIANTS = 40
MOST_NEGATIVES = 3000
LEAST_SHARE = 0.5
LEAST_PROBABILITY = 0.5
SEED = 7


#: Trigrams of a notice lie in a window of so many times their number.
WINDOW = 2


class Classifier(NamedTuple):
    weights: np.ndarray
    temperature: float
    trigrams: dict[str, np.ndarray]
    words: np.ndarray


class Window(NamedTuple):
    """Words of a paragraph that hold a share of a template of a family; places are those of all words."""

    start: int
    end: int
    family: int
    share: float


def grams(codes: np.ndarray) -> np.ndarray:
    """Hashed unigrams and bigrams of a paragraph."""
    pairs = W.sequence_codes(codes, 2)
    return (np.concatenate((codes, pairs)) % np.uint64(CELLS)).astype(np.int64)


def features(paragraphs: list[np.ndarray]) -> np.ndarray:
    x = np.zeros((len(paragraphs), CELLS + 1))
    for i, codes in enumerate(paragraphs):
        cells, n = np.unique(grams(codes), return_counts=True)
        x[i, cells] = n / np.sqrt((n * n).sum()) if len(n) else 0.0
    x[:, -1] = 1.0
    return x


def codes_of(paragraphs: list[str]) -> list[np.ndarray]:
    found = W.words_of(W.texts_of(pa.array(paragraphs, pa.string()), lower=True), W.NOT_ALNUM_TABLE)
    return [found.code[a:b] for a, b in zip(found.first[:-1], found.first[1:])]


def full_text(family: str) -> list[str]:
    """The lines with words of a family's full text, and its paragraphs as one line each."""
    path = TEXTS / f"{family}.txt"
    text = path.read_text() if path.exists() else ""
    parts = text.split("\n") + [part.replace("\n", " ") for part in text.split("\n\n")]
    return [part for part in dict.fromkeys(parts) if any(c.isalnum() for c in part)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def trained(negatives: list[str], rounds: int = 200) -> Classifier:
    """The classifier of all notices against these paragraphs, by momentum descent."""
    random = np.random.default_rng(SEED)
    examples, labels, trigrams = [], [], {}
    for k, family in enumerate(FAMILIES[:-1]):
        own = codes_of(list(NOTICES[family]))
        trigrams[family] = np.unique(np.concatenate([W.sequence_codes(c, 3) for c in own]))
        for codes in own:
            examples.append(codes)
            labels.append(k)
            for _ in range(VARIANTS):
                kept = codes[random.random(len(codes)) > 0.15]
                examples.append(kept if len(kept) else codes)
                labels.append(k)
        short, full = codes_of(list(IDENTIFIERS[family])), codes_of(full_text(family))
        examples += short * (VARIANTS // 4) + full
        labels += [k] * (len(short) * (VARIANTS // 4) + len(full))
        trigrams[family] = np.unique(np.concatenate([trigrams[family], *(W.sequence_codes(c, 3) for c in full)]))
    rest = [c for c in codes_of(negatives) if len(c)]
    examples += rest
    labels += [len(FAMILIES) - 1] * len(rest)
    x, y = features(examples), np.eye(len(FAMILIES))[labels]
    held = np.arange(len(y)) % 5 == 0
    weight, speed = np.zeros((CELLS + 1, len(FAMILIES))), 0.0
    fit, target = x[~held], y[~held]
    balance = (1.0 / np.maximum(target.sum(axis=0), 1))[target.argmax(axis=1)][:, None]
    for _ in range(rounds):
        slope = fit.T @ ((softmax(fit @ weight) - target) * balance) + 1e-5 * weight
        speed = 0.9 * speed - 2.0 * slope
        weight += speed
    scores, chosen = x[held] @ weight, y[held].argmax(axis=1)
    grid = np.geomspace(0.1, 4.0, 40)
    loss = [-np.log(softmax(scores / t)[np.arange(len(chosen)), chosen] + 1e-12).mean() for t in grid]
    words = np.unique(np.concatenate([c for c, k in zip(examples, labels) if k < len(FAMILIES) - 1]))
    return Classifier(weight, float(grid[int(np.argmin(loss))]), trigrams, words)


def scores(weights: np.ndarray, found: W.Words, most: int = 1 << 18) -> np.ndarray:
    """What `features` times the weights gives, for each paragraph, by its own cells only."""
    n = len(found.first) - 1
    out = np.tile(weights[-1], (n, 1))
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(found.first, found.first[low] + most, "right")) - 1)
        code = found.code[found.first[low] : found.first[high]]
        place = np.repeat(np.arange(high - low), np.diff(found.first[low : high + 1]))
        within = place[1:] == place[:-1]
        cell = np.concatenate((code, W.sequence_codes(code, 2)[within])) % np.uint64(CELLS)
        place = np.concatenate((place, place[:-1][within]))
        key, times = np.unique(place * CELLS + cell.astype(np.int64), return_counts=True)
        place, cell = key // CELLS, key % CELLS
        value = times / np.sqrt(np.bincount(place, times * times, high - low))[place]
        for k in range(weights.shape[1]):
            out[low:high, k] += np.bincount(place, value * weights[cell, k], high - low)
        low = high
    return out


def own_shares(found: W.Words, known: list[np.ndarray]) -> np.ndarray:
    """The share of each paragraph's trigrams that each family has."""
    n, three = len(found.first) - 1, W.sequence_codes(found.code, 3)
    near = in_sorted(np.unique(np.concatenate(known)), three)
    near = near[W.whole_starts(found.first, 3, len(found.code))[near]]
    paragraph, total = np.searchsorted(found.first, near, "right") - 1, np.maximum(np.diff(found.first) - 2, 1)
    return np.column_stack([np.bincount(paragraph[np.isin(three[near], own)], minlength=n) / total for own in known])


def windows_of(found: W.Words) -> dict[int, list[Window]]:
    """Of each paragraph: windows that hold enough of a notice, a whole identifier, or another licence's name (UNKNOWN)."""
    out: dict[int, list[Window]] = {}

    def add(start: int, end: int, family: int, share: float) -> None:
        paragraph = int(np.searchsorted(found.first, start, "right")) - 1
        out.setdefault(paragraph, []).append(Window(start, end, family, share))

    notices, identifiers = [], {}
    for k, family in enumerate(FAMILIES[:-1]):
        notices += [(k, np.unique(W.sequence_codes(c, 3))) for c in codes_of(list(NOTICES[family]))]
        for c in codes_of(list(IDENTIFIERS[family])):
            identifiers.setdefault(len(c), {})[W.whole_code(c)] = k
    for c in codes_of(list(OTHERS)):
        identifiers.setdefault(len(c), {})[W.whole_code(c)] = UNKNOWN
    for length, family_of in identifiers.items():
        codes = W.sequence_codes(found.code, length)
        at = in_sorted(np.array(sorted(family_of), np.uint64), codes)
        for p in at[W.whole_starts(found.first, length, len(found.code))[at]].tolist():
            add(p, p + length, family_of[int(codes[p])], 1.0)
    three = W.sequence_codes(found.code, 3)
    near = in_sorted(np.unique(np.concatenate([own for _, own in notices])), three)
    near = near[W.whole_starts(found.first, 3, len(found.code))[near]]
    paragraph = np.searchsorted(found.first, near, "right") - 1
    for k, own in notices:
        some = np.isin(three[near], own)
        places, code, line = near[some], three[near][some], paragraph[some]
        upto = np.minimum(np.searchsorted(places, places + WINDOW * len(own)), np.searchsorted(line, line, "right"))
        best: dict[int, tuple[float, int, int]] = {}
        for i in np.flatnonzero(upto - np.arange(len(places)) >= LEAST_SHARE * len(own)).tolist():
            _, last = np.unique(code[i : upto[i]], return_index=True)
            one = (len(last) / len(own), -int(places[i + last.max()] - places[i]), int(places[i]))
            if one[0] >= LEAST_SHARE:
                # The best window of each stretch that is as long as a window.
                stretch = int(places[i]) // (WINDOW * len(own))
                best[stretch] = max(best.get(stretch, one), one)
        for share, span, start in best.values():
            add(start, start - span + 3, k, share)
    return out


def sampled_paragraphs(documents: DataFrame, most: int = MOST_NEGATIVES) -> list[str]:
    """At most `most` distinct paragraphs of the corpus without a licence's words, those of the smallest hashes."""
    lines = documents.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line"))
    lines = lines.where("length(trim(line)) between 10 and 2000").where(~F.col("line").rlike("(?i)licen|permi|redistribut"))
    lines = lines.withColumn("h", F.xxhash64("line"))

    def least(batches):
        held = np.zeros(0, np.int64)
        for batch in batches:
            held = np.unique(np.concatenate((held, batch["h"].to_numpy())))[:most]
        yield pa.record_batch({"h": pa.array(held)})

    hashes = lines.select("h").mapInArrow(least, "h bigint").distinct().orderBy("h").limit(most).collect()
    if not hashes:
        return []
    rows = lines.where(F.col("h") <= hashes[-1]["h"]).select("h", "line").distinct()
    return [row["line"] for row in rows.orderBy("h", "line").limit(most).collect()]


RESULT = (
    "doc_id bigint, n_paragraphs bigint, n_license bigint, n_unknown bigint, family string, probability double, "
    "share double, found array<struct<paragraph:bigint,family:string,probability:double,share:double>>"
)


def license_scan(documents: DataFrame) -> DataFrame:
    """One row for each row of `documents` (doc_id, text).

    n_paragraphs, n_license (confirmed paragraphs), n_unknown (licence-like but not confirmed), the
    family, probability and template share of the most probable confirmed paragraph (null, 0, 0 without
    one), and `found`, all confirmed and unknown paragraphs; a paragraph that holds notices of several
    families apart is there once for each.  A null text has no paragraphs.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(tuple(trained(sampled_paragraphs(docs))))

    def run(batches):
        model = Classifier(*shared.value)
        known = [model.trigrams[family] for family in FAMILIES[:-1]]
        for batch in batches:
            rows = []
            texts = batch["text"].to_pylist()
            lines = [(i, k, p) for i, t in enumerate(texts) if t is not None for k, p in enumerate(t.split("\n"))]
            found = W.words_of(W.texts_of(pa.array([p for *_, p in lines], pa.string()), lower=True), W.NOT_ALNUM_TABLE)
            count = np.diff(found.first)
            chances = softmax(scores(model.weights, found) / model.temperature)
            shares = own_shares(found, known)
            windows = windows_of(found)
            flat = [w for p in windows for w in windows[p] if w.family != UNKNOWN]
            sure: dict[Window, float] = {}
            for low in range(0, len(flat), 512):
                part = flat[low : low + 512]
                given = softmax(features([found.code[w.start : w.end] for w in part]) @ model.weights / model.temperature)
                sure |= {w: float(g[w.family]) for w, g in zip(part, given) if g[w.family] >= LEAST_PROBABILITY}
            top = chances[:, :-1].argmax(axis=1)
            # Words that no template has share cells with those of templates and tell nothing.
            known_words = np.bincount(np.searchsorted(found.first, in_sorted(model.words, found.code), "right") - 1, minlength=len(count))
            like = (chances[:, -1] < LEAST_PROBABILITY) & (known_words >= LEAST_SHARE * count)
            for p in np.flatnonzero((count > 0) & (like | np.isin(np.arange(len(count)), list(windows)))).tolist():
                others = [w for w in windows.get(p, []) if w.family == UNKNOWN]
                apart = (w for w in windows.get(p, []) if all(w.end <= o.start or o.end <= w.start for o in others))
                own = sorted((w for w in apart if w in sure), key=lambda w: (-w.share, w.start - w.end, -sure[w]))
                kept: list[Window] = []
                for w in own:
                    if all(w.family != k.family and (w.end <= k.start or k.end <= w.start) for k in kept):
                        kept.append(w)
                rows += [(*lines[p][:2], FAMILIES[w.family], sure[w], w.share) for w in kept]
                if not kept:
                    value, share = float(chances[p, top[p]]), float(shares[p, top[p]])
                    confirmed = value >= LEAST_PROBABILITY and share >= LEAST_SHARE and not others
                    rows.append((*lines[p][:2], FAMILIES[top[p]] if confirmed else "unknown", value, share))
            out: list[list] = [[] for _ in texts]
            for i, k, family, value, share in rows:
                out[i].append({"paragraph": k, "family": family, "probability": value, "share": share})
            best = [
                max((x for x in o if x["family"] != "unknown"), key=lambda x: (x["probability"], -x["paragraph"]), default=None)
                for o in out
            ]
            kind = pa.list_(
                pa.struct(
                    [("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("share", pa.float64())]
                )
            )
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_paragraphs": pa.array([0 if t is None else t.count("\n") + 1 for t in texts], pa.int64()),
                    "n_license": pa.array([len({x["paragraph"] for x in o if x["family"] != "unknown"}) for o in out], pa.int64()),
                    "n_unknown": pa.array([sum(x["family"] == "unknown" for x in o) for o in out], pa.int64()),
                    "family": pa.array([b and b["family"] for b in best], pa.string()),
                    "probability": pa.array([b["probability"] if b else 0.0 for b in best], pa.float64()),
                    "share": pa.array([b["share"] if b else 0.0 for b in best], pa.float64()),
                    "found": pa.array(out, kind),
                }
            )

    return docs.mapInArrow(run, RESULT)
