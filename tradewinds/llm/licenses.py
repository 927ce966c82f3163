"""Licence notices in documents: a paragraph classifier, an unknown class, templates that confirm.

A paragraph is a line of a text. Its features are indicators of one to three words in a row (letters and
digits, in lower case). A multinomial logistic regression over these sparse indicators tells the licence
families, with a class `unknown` for everything else. It is fitted on notices made from `TEMPLATES`
(whole, with words left out, and with other words around them) and, for `unknown`, on up to
`SAMPLE_LINES` lines of the corpus that share no two words in a row with a template, and on
`NEAR_MISSES`. Temperature and the least probability for a family are set on a quarter of these that the
fit has not seen, so that at most `FALSE_SHARE` of the unknown ones pass.

Only words of the templates have weights, so a paragraph without any scores as the offsets say (unknown).

A prediction is confirmed if at least `LEAST_COVER` of a template of that family, by words in a row,
stands in the paragraph; `template` and `cover` tell which and how much.

Defined cases: null text is empty; empty texts have no paragraphs and no notices; a paragraph that repeats
is reported each time; rows that repeat get their rows each; very long texts and lines are read whole;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, map_documents, sampled
from tradewinds.llm.text import CLEAN, Words, as_bytes, blocks, chained, joined

SAMPLE_LINES = 3_000
FALSE_SHARE = 0.001
LEAST_COVER = 0.6
IN_A_ROW = 3
UNKNOWN = "unknown"

# Names of licences by family.
NAMES = {
    "mit": ["MIT License", "MIT licence", "Expat License"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "gpl-3.0": ["GNU General Public License, version 3", "GNU GPL version 3", "GNU General Public License v3.0", "GPLv3"],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU GPL version 2", "GNU General Public License v2.0", "GPLv2"],
    "lgpl": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License", "LGPL version 2.1"],
    "agpl-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License", "AGPLv3"],
    "bsd": ["BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "BSD license"],
    "mpl-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "isc": ["ISC License"],
    "epl-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0"],
    "cc0": ["CC0 1.0 Universal", "Creative Commons Zero", "CC0 public domain dedication"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY 3.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0"],
    "cc-by-nd": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc-by-nc-sa": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
}
# How notices name a licence.
PHRASES = [
    "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.", "This work is licensed under a {}.",
    "Released under the {}.", "Distributed under the {}.", "This software is released under the {}.", "License: {}",
    "Available under the terms of the {}.", "Published under {}.",
]
# Notices of their own wording.
TEMPLATES = {
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "gpl-3.0": ["either version 3 of the License, or (at your option) any later version"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "public-domain": ["This work is in the public domain.", "Dedicated to the public domain."],
    "proprietary": ["All rights reserved.", "No part of this publication may be reproduced without permission.",
                    "Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
# Lines that speak of licences and give none.
NEAR_MISSES = [
    "he lost his driving license", "the license plate of the car", "a fishing license is required here",
    "licensed electrician available today", "all rights of way were reserved for walkers", "released under pressure from the public",
    "the general public was invited", "version 3 of the report", "version 2 is out now", "creative people share common ideas",
    "the work is under way", "distributed under the bridge", "this software is slow", "the apache helicopter landed",
    "he was released under bail", "public transport to the domain", "terms of the contract", "free of charge for children",
    "the student went to mit", "copy of the letter", "permission to land", "an attribution error", "table reserved for two",
]


def notices() -> dict[str, list[str]]:
    out = {family: [phrase.format(name) for name in names for phrase in PHRASES] + names for family, names in NAMES.items()}
    for family, texts in TEMPLATES.items():
        out.setdefault(family, []).extend(texts)
    return out


def _grams(words: np.ndarray) -> np.ndarray:
    found = [chained([words[k:len(words) - n + 1 + k] for k in range(n)]) for n in range(1, IN_A_ROW + 1) if len(words) >= n]
    return np.unique(np.concatenate([*found, words[:0]]))


def _line_words(text: str) -> np.ndarray:
    return Words(CLEAN[joined([as_bytes(text.lower())])]).hashes()


def lines(texts: list[str | None]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: the first text's position, the bytes, word hashes, where lines begin among them, and in bytes."""
    for first, block in blocks([(t or "").lower() for t in texts]):
        data = joined(block)
        words = Words(CLEAN[data])
        starts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
        yield first, block, words.hashes(), np.searchsorted(words.starts, starts), starts


@dataclass
class Model:
    families: list[str]  # the last is UNKNOWN
    grams: np.ndarray  # sorted hashes with weights
    weights: np.ndarray  # a row per gram
    offsets: np.ndarray
    temperature: float
    least: float
    templates: list[tuple[int, str, np.ndarray]]  # family, text, its grams of two and three words

    def probabilities(self, grams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        z = (self.weights[at[self.grams[at] == grams]].sum(0) + self.offsets) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def lines_found(self, words: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers and probabilities of the lines (words from at[k] to at[k + 1]) that are a family's."""
        line = np.repeat(np.arange(len(at) - 1), np.diff(at))
        size, pairs = len(self.grams), []
        table = np.zeros(2**16, bool)
        table[(self.grams & np.uint64(0xFFFF)).astype(np.int64)] = True
        for n in range(1, IN_A_ROW + 1):
            if len(words) < n:
                break
            grams = chained([words[k:len(words) - n + 1 + k] for k in range(n)])
            places = np.flatnonzero(table[(grams & np.uint64(0xFFFF)).astype(np.int64)] & (line[:len(grams)] == line[n - 1:]))
            number = np.minimum(np.searchsorted(self.grams, grams[places]), size - 1)
            same = self.grams[number] == grams[places]
            pairs.append(line[places[same]] * size + number[same])
        pairs = np.unique(np.concatenate([*pairs, np.empty(0, np.int64)]))
        scored, begins = np.unique(pairs // size, return_index=True)
        if not len(scored):
            return
        z = (np.add.reduceat(self.weights[pairs % size], begins, axis=0) + self.offsets) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        for k in np.flatnonzero(p[:, :-1].max(1) >= self.least):
            yield int(scored[k]), p[k]

    def cover(self, family: int, words: np.ndarray) -> tuple[float, str]:
        """The best share of a template of the family that stands in the words."""
        there = _runs(words)
        shares = [(float(np.isin(grams, there).mean()), text) for number, text, grams in self.templates if number == family]
        return max(shares, default=(0.0, ""))


def _runs(words: np.ndarray) -> np.ndarray:
    found = [chained([words[k:len(words) - n + 1 + k] for k in range(n)]) for n in (2, 3) if len(words) >= n]
    return np.unique(np.concatenate([*found, words[:0]])) if len(words) > 1 else words


def fit_model(unknown_lines: list[str], rounds: int = 120) -> Model:
    random = np.random.default_rng(11)
    every = notices()
    families = [*sorted(every), UNKNOWN]
    templates = [(families.index(f), text, _runs(_line_words(text))) for f in sorted(every) for text in every[f]]
    known_runs = np.unique(np.concatenate([grams for *_, grams in templates]))
    others = [w for w in map(_line_words, unknown_lines) if not np.isin(_runs(w), known_runs).any()]
    rows, target = [], []
    around = [w for w in others if len(w)] or [np.zeros(1, np.uint64)]
    for family, texts in every.items():
        for text in texts:
            words = _line_words(text)
            some = around[random.integers(len(around))][:12]
            variants = [words, np.concatenate([some, words]), np.concatenate([words, some])]
            if len(words) > 5:
                variants.append(np.delete(words, random.integers(len(words) - 4)))
            rows += [_grams(v) for v in variants]
            target += [families.index(family)] * len(variants)
    misses = [_line_words(t) for t in NEAR_MISSES for _ in range(4)]
    rows += [_grams(w) for w in [*others, *misses]]
    target += [len(families) - 1] * (len(others) + len(misses))
    target = np.array(target)
    vocabulary = np.unique(np.concatenate([_grams(_line_words(t)) for texts in every.values() for t in texts]))
    apart = random.permutation(len(rows)) % 4 == 0
    use = np.flatnonzero(~apart)
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for k, grams in enumerate(rows):
        at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
        x[k, at[vocabulary[at] == grams]] = 1
    weights, offsets = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32)
    squares, offset_squares = np.full_like(weights, 1e-3), np.full_like(offsets, 1e-3)
    one = np.eye(len(families), dtype=np.float32)[target]
    xs = x[use]
    for _ in range(rounds):
        z = xs @ weights + offsets
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - one[use]) / len(use) * 50
        slope = xs.T @ error + 0.002 * weights
        squares += slope**2
        offset_squares += error.sum(0) ** 2
        weights -= 0.3 * slope / np.sqrt(squares)
        offsets -= 0.3 * error.sum(0) / np.sqrt(offset_squares)
    z = x[apart] @ weights + offsets

    def shares_of(z: np.ndarray, temperature: float) -> np.ndarray:
        p = np.exp((z - z.max(1, keepdims=True)) / temperature)
        return p / p.sum(1, keepdims=True)

    def shares(temperature: float) -> np.ndarray:
        return shares_of(z, temperature)

    truth = target[apart]
    temperature = min(np.geomspace(0.3, 5, 25), key=lambda t: -np.log(shares(t)[np.arange(len(truth)), truth] + 1e-12).mean())
    false = np.sort(shares(temperature)[truth == len(families) - 1, :-1].max(1, initial=0))
    allowed = int(FALSE_SHARE * len(false))
    # A line without any of the words must stay unknown too.
    silent = shares_of(offsets[None], temperature)[0, :-1].max()
    least = max(0.5, float(silent) + 1e-6, float(false[len(false) - 1 - allowed]) + 1e-6 if len(false) else 0.5)
    return Model(families, vocabulary, weights, offsets, float(temperature), min(least, 0.99), templates)


def fit(docs: DataFrame) -> Model:
    """A model whose unknown class knows a bounded sample of the corpus's own lines."""
    # One of the first three lines of a document, by its id.
    number = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) + 1).cast("int")
    line = F.substring(F.try_element_at(F.split("text", "\n", 4), number), 1, 400)
    lines_of = documents(docs).select("doc_id", line.alias("text")).where(F.length("text") > 0)
    rows = sampled(lines_of, SAMPLE_LINES, counted=docs).orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    return fit_model([r.text for r in rows])


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, line (from 0), family, probability, confirmed, template, cover, text: a row per notice found."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts, rows = list(batch["doc_id"]), list(batch["text"]), []
            for first, block, words, at, starts in lines(texts):
                begins = np.cumsum([0, *(len(b) + 1 for b in block)])
                for k, p in model.lines_found(words, at):
                    own, family = words[at[k]:at[k + 1]], int(p[:-1].argmax())
                    n = int(np.searchsorted(begins, starts[k], side="right")) - 1
                    number = int(k - np.searchsorted(starts, begins[n]))
                    share, template = model.cover(family, own)
                    text = (texts[first + n] or "").split("\n")[number]
                    rows.append((ids[first + n], number, model.families[family], float(p[family]), share >= LEAST_COVER,
                                 template, share, text))
            yield pd.DataFrame(rows, columns=["doc_id", "line", "family", "probability", "confirmed", "template", "cover", "text"])

    return map_documents(
        documents(docs), found,
        "doc_id bigint, line int, family string, probability double, confirmed boolean, template string, cover double, text string",
    )
